"""Dataset-level operators: DataFrame in, DataFrame (or a small fitted value) out."""
