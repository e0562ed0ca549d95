"""barcodeforge.operators."""
