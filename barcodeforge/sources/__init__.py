"""barcodeforge.sources."""
