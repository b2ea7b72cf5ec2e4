from .inputs import READERS, load_inputs, read_input

__all__ = ["READERS", "load_inputs", "read_input"]
