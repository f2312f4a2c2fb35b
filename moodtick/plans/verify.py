"""Console verification runs: the pipeline's intermediate streams printed per
micro-batch, one stage at a time (parsed events; cleaned and scored headlines;
joined windows).

``stage="parsed"`` and ``"scored"`` start two named queries (prices_stream,
texts_stream); ``"joined"`` starts one on the joined windows. ``await_all`` in
``streaming.pipeline`` blocks on them and surfaces a failure of either.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..config import DEFAULT, Config
from ..operators.parse import parse_prices, parse_texts
from ..operators.windows import clean_and_score
from ..streaming.pipeline import to_console
from .pipeline import correlate

# Query names and printed rows per batch of each stage.
ROWS = {"parsed": 5, "scored": 3, "joined": 10}
PRICES_QUERY, TEXTS_QUERY = "prices_stream", "texts_stream"


def start_verification(price_env: DataFrame, text_env: DataFrame, lexicon, stage: str, cfg: Config = DEFAULT,
                       checkpoint_root: str | None = None, trigger: dict | None = None) -> list[StreamingQuery]:
    ck = (lambda name: f"{checkpoint_root}/{name}") if checkpoint_root else (lambda name: None)
    prices, texts = parse_prices(price_env), parse_texts(text_env)
    n = ROWS[stage]
    if stage == "parsed":
        return [to_console(prices, PRICES_QUERY, n, ck(PRICES_QUERY), trigger),
                to_console(texts, TEXTS_QUERY, n, ck(TEXTS_QUERY), trigger)]
    if stage == "scored":
        return [to_console(prices, PRICES_QUERY, n, ck(PRICES_QUERY), trigger),
                to_console(clean_and_score(texts, lexicon, cfg), TEXTS_QUERY, n, ck(TEXTS_QUERY), trigger)]
    if stage == "joined":
        return [to_console(correlate(prices, texts, lexicon, cfg), "joined_stream", n, ck("joined_stream"), trigger)]
    raise ValueError(f"unknown stage {stage!r}")
