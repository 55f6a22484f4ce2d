"""Stop-word lists shipped with the package, so that they need neither a session nor Spark's jars.

The files under ``data`` hold the lists that Spark's ``StopWordsRemover`` loads (from the Snowball
project, BSD licence), one word a line; a test compares them with the running Spark.
"""

from __future__ import annotations

import os
from functools import lru_cache

FOLDER = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "data")


@lru_cache(maxsize=None)
def default_stopwords(language: str = "english") -> tuple[str, ...]:
    """Words of a shipped list: english, french, german or spanish."""
    path = os.path.join(FOLDER, f"stopwords_{language}.txt")
    if not os.path.exists(path):
        raise ValueError(f"no stop-word list for {language}")
    with open(path, encoding="utf-8") as file:
        return tuple(line.rstrip("\n") for line in file)
