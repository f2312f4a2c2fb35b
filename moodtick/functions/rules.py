"""Position rules of the lexicon scorer, as array functions over a text's tokens.

On top of the valence sum: words that strengthen or weaken, and negations, act on a scored
word up to three tokens behind them; a contrast word ("but") halves what stands before it
and raises what stands behind; exclamation and question marks push the sum away from zero.
The word lists are the user's; the weights are those published for this family of rules
(Hutto and Gilbert, 2014) and are parameters too.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from .sentiment import _scored_text, checked_lexicon, compound, lexicon_map
from .text import TOKEN_SPLIT


@dataclass(frozen=True)
class Rules:
    """Word lists and weights. ``boosters``: word -> +1 (strengthens) or -1 (weakens)."""

    negations: frozenset[str] = frozenset({"not", "no", "never", "without", "neither", "nor"})
    boosters: Mapping[str, int] = field(default_factory=lambda: {"very": 1, "extremely": 1, "slightly": -1, "barely": -1})
    contrast: frozenset[str] = frozenset({"but"})
    # Weights of the rules.
    boost: float = 0.293
    fading: tuple[float, ...] = (1.0, 0.95, 0.9)  # of a booster one, two, three tokens back
    negated: float = -0.74
    before_contrast: float = 0.5
    behind_contrast: float = 1.5
    exclamation: float = 0.292
    most_exclamations: int = 4
    question: float = 0.18
    most_questions: float = 0.96


def _among(token: Column, words) -> Column:
    return token.isin(*sorted(words)) if words else F.lit(False)


def _count(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def emphasis(text: Column, rules: Rules) -> Column:
    """What the marks of a text add: up to four exclamation marks; two or three question
    marks count each, more of them a fixed amount."""
    q = _count(text, "?")
    ask = F.when(q <= 1, 0.0).when(q <= 3, q * F.lit(rules.question)).otherwise(rules.most_questions)
    return F.least(_count(text, "!"), F.lit(rules.most_exclamations)) * F.lit(rules.exclamation) + ask


def rule_sum(cleaned: Column, lexicon: Mapping[str, float], rules: Rules = Rules(), cfg: Config = DEFAULT) -> Column:
    """Sum of the valences of a cleaned text's tokens under the rules (NULL only under
    null_policy="skip"). Linear in the text: every token looks at three before it."""
    lex, text = checked_lexicon(lexicon), _scored_text(cleaned, cfg)
    boosts = lexicon_map({w: float(s) * rules.boost for w, s in rules.boosters.items()})
    words = F.filter(F.split(text, TOKEN_SPLIT), lambda t: t != "")
    # one struct per token: its valence, what it boosts by, whether it negates or contrasts
    marked = F.transform(words, lambda t: F.struct(
        F.coalesce(F.try_element_at(lexicon_map(lex), t), F.lit(0.0)).alias("v"),
        F.coalesce(F.try_element_at(boosts, t), F.lit(0.0)).alias("b"),
        _among(t, rules.negations).alias("n"), _among(t, rules.contrast).alias("c")))

    def scored(tokens: Column) -> Column:
        turn = F.array_position(F.transform(tokens, lambda x: x["c"]), F.lit(True)) - 1  # -1: none

        def one(x: Column, i: Column) -> Column:
            back = [F.try_element_at(tokens, i + 1 - d) for d in range(1, len(rules.fading) + 1)]
            here = [F.when(i >= d, t) for d, t in enumerate(back, 1)]  # no wrap-around at the start
            # a scored word does not boost; a booster pushes away from zero
            push = sum(F.coalesce(F.when(t["v"] == 0, t["b"] * F.lit(w)), F.lit(0.0)) for t, w in zip(here, rules.fading))
            v = x["v"] + F.signum(x["v"]) * push
            negated = F.lit(False)
            for t in here:
                negated = negated | F.coalesce(t["n"], F.lit(False))
            v = F.when(negated, v * F.lit(rules.negated)).otherwise(v)
            side = F.when(turn < 0, 1.0).when(i < turn, rules.before_contrast).when(i > turn, rules.behind_contrast).otherwise(1.0)
            return F.when(x["v"] == 0, F.lit(0.0)).otherwise(v * side)

        return F.aggregate(F.transform(tokens, one), F.lit(0.0), lambda a, v: a + v)

    m = F.transform(F.array(marked), scored).getItem(0)
    extra = emphasis(text, rules)
    return F.transform(F.array(m), lambda x: x + F.signum(x) * extra).getItem(0)


def score_rules(cleaned: Column | str, lexicon: Mapping[str, float], rules: Rules = Rules(), cfg: Config = DEFAULT) -> Column:
    """Compound score under the rules; usable as ``score=`` of the pipeline through a lambda."""
    c = F.col(cleaned) if isinstance(cleaned, str) else cleaned
    return compound(rule_sum(c, lexicon, rules, cfg), cfg)
