from . import dates, measures, names, text, urls  # noqa: F401
