"""Running, windowed and full-book quote operators."""
