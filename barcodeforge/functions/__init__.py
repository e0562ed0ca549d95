"""barcodeforge.functions."""
