"""Writers: the only code here with side effects."""
