"""Settings of the analysis: every tunable of the work in one frozen dataclass."""

from __future__ import annotations

from dataclasses import dataclass, field

# The subject keywords a comment must mention to enter the topic corpus.
SUBJECT_KEYWORDS = (
    "climate", "warming", "carbon", "emission", "greenhouse", "temperature",
    "fossil", "renewable", "energy", "pollution", "environment", "sustainability",
    "weather", "ice", "sea", "level", "drought", "flood",
)


@dataclass(frozen=True)
class Settings:
    # sampling
    # shares of the dump and of the topic corpus; 1.0 keeps all rows
    sample_fraction: float = 1.0
    seed: int = 42
    # cleaning
    min_text_length: int = 10
    min_tokens: int = 5
    # lexicon score classes
    positive_threshold: float = 0.05
    negative_threshold: float = -0.05
    categories: tuple[str, ...] = ("Positive", "Negative", "Neutral")
    # report sizes
    group_min_size: int = 1000
    top_words: int = 50
    top_words_per_label: int = 30
    # topics
    num_topics: int = 5
    topic_iterations: int = 10
    topic_vocab_size: int = 2000
    topic_min_df: float = 10.0
    topic_sample_fraction: float = 1.0
    terms_per_topic: int = 15
    keywords: tuple[str, ...] = field(default=SUBJECT_KEYWORDS)
    # classifiers
    vocab_size: int = 3000
    min_df: float = 3.0
    test_ratio: float = 0.2
    num_trees: int = 50
    max_depth: int = 10
    smoothing: float = 1.0
    best_by: str = "f1"
    # a lookup table with more rows than this is joined by shuffle, not broadcast
    broadcast_rows: int = 500_000
    # a lookup table with more rows than this is not inlined into an expression
    inline_rows: int = 20_000


DEFAULTS = Settings()
