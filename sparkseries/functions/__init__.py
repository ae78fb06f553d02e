from . import numeric, payload, text, times

__all__ = ["numeric", "payload", "text", "times"]
