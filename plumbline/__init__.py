"""A PySpark-native engine for visual-inspection data: catalogues, regions of interest, labels and exports."""
