"""Column selection by name pattern.

The survey files carry an open-ended number of answer columns named
``pca_<n>``. A column belongs to the answer set when the pattern matches at
the *start* of its name, case-sensitively (Python ``re.match`` semantics):
``pca_12abc`` and ``pca_1_total`` match, ``pca_total``, ``xpca_3`` and
``PCA_1`` do not. Spark's ``colRegex`` is a full, case-insensitive match, so it
is not used here. Only the column list lives on the driver.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

# Fixed value: name pattern of the survey answer columns.
ANSWER_PATTERN = r"pca_\d+"


def matching_columns(columns: Iterable[str], pattern: str = ANSWER_PATTERN) -> list[str]:
    """Names in ``columns`` that the pattern matches at their start, in frame order."""
    rx = re.compile(pattern)
    return [c for c in columns if rx.match(c)]
