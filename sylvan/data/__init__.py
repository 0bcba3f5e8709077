"""Public word lists read with importlib.resources."""
