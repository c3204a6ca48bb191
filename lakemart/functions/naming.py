"""Column-name rules. These act on names only, on the driver."""

from __future__ import annotations

import re

# A capital starts a new word when a small letter or digit precedes it, or a small letter follows it.
_WORD_START = re.compile(r"(?<=[a-z0-9])(?=[A-Z])|(?<=.)(?=[A-Z][a-z])")


def camel_to_snake(name: str) -> str:
    """``PULocationID`` -> ``pu_location_id``."""
    return _WORD_START.sub("_", name).lower()


def spaced_to_snake(name: str, squeeze: bool = False) -> str:
    """Like :func:`camel_to_snake` with blanks as ``_`` too: ``Case Number`` -> ``case__number``.

    ``squeeze`` merges the doubled underscores this leaves (``case_number``).
    """
    snake = camel_to_snake(name).replace(" ", "_")
    return re.sub("_+", "_", snake) if squeeze else snake


def label_to_snake(name: str) -> str:
    """Blank, ``-``, ``/`` and ``.`` become ``_``; the rest is lower-cased: ``Club.Name`` -> ``club_name``."""
    return re.sub(r"[ \-/.]", "_", name).lower()


NAME_STYLES = {"camel": camel_to_snake, "spaced": spaced_to_snake, "label": label_to_snake}
