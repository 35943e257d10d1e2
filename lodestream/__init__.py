"""Privacy-aware processing of conversation and document event streams on Spark."""
