"""Generic DataFrame operators the normalizers and reports are composed of."""
