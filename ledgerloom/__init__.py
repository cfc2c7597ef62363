"""ledgerloom: DataFrame operators that turn loosely structured records into a resolved, auditable dataset."""

__version__ = "0.1.0"
