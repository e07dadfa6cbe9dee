"""Notices in the middle of sentences, tags, parts that vary, standard headers; and what must be left alone."""

import pytest

from plumbline.llm import licenses

APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    {}://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""

BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

3. Neither the name of {} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY {} "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."""


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("This project is released under the MIT license.", ["MIT"]),
        ("SPDX-License-Identifier: MIT OR (GPL-2.0-only WITH Classpath-exception-2.0)", ["GPL-2.0-only", "MIT"]),
        ("// SPDX-License-Identifier: BSL-1.0\ncode", ["BSL-1.0"]),
        ("It is distributed under the terms of the GNU Lesser General Public License, version 2.1 or later.", ["LGPL-2.1-or-later"]),
        ("foo is licensed under the Boost Software License.", ["BSL-1.0"]),
        ("docs are licensed under CC BY-SA 4.0, code under GPLv3, no more", ["CC-BY-SA-4.0"]),
        ("dual licensed: available under AGPL v3+", ["AGPL-3.0-or-later"]),
        ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 2.1 of the License, or (at your option) any later version.", ["LGPL-2.1-or-later"]),
        (APACHE.format("http"), ["Apache-2.0"]),
        (APACHE.format("https"), ["Apache-2.0"]),
        (BSD.format("Foo Inc. of Bar", "FOO AND OTHERS"), ["BSD-3-Clause"]),
        ("He was released by the MIT team. A license is a thing.", []),
        ("available under the counter, by GPL people", []),
        ("", []),
        (None, []),
    ],
)
def test_recognised(text, want):
    found, matches = licenses.Scanner().scan(text)
    assert sorted({m[0] for m in matches}) == want
    assert all(found[i][1] <= found[i + 1][0] for i in range(len(found) - 1))
    if text in (APACHE.format("http"), APACHE.format("https")):
        assert len(matches) == 1


def test_many_notices_and_long_texts():
    text = ("Words of prose without meaning here. " * 50 + "It is released under the ISC license, friends.\n") * 400
    found, matches = licenses.Scanner().scan(text)
    assert len(matches) == 400 and {m[0] for m in matches} == {"ISC"} and text[matches[7][1] : matches[7][2]] == "released under the ISC"
