"""barcodeforge.plans."""
