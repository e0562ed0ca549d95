"""barcodeforge.streaming."""
