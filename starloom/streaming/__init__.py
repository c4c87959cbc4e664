from starloom.streaming.incremental import IncrementalStar, load_available, write_batch

__all__ = ["IncrementalStar", "load_available", "write_batch"]
