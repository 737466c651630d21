"""Part of emberline."""
