"""The registered queries; importing the package registers all of them in catalogue."""

from . import advanced, catalogue, files, marked, more, stats  # noqa: F401
