from tablewright.functions import dates, nulls

__all__ = ["dates", "nulls"]
