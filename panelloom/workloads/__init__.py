"""The engine's operators run over whole supplied tables, each beside an equivalent SQL text."""
