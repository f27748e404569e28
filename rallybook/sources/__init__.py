"""Reading, writing and landing of tables."""
