"""Part of the record-matching engine."""
