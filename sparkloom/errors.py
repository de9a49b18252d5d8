class ValidationError(ValueError):
    """Raised for bad columns, bad types, unknown options and failed checks."""
