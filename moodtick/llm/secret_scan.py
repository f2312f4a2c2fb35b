"""Secret scan: candidates, and a random forest that removes the false ones.

A candidate is a long run of key characters with a digit in it, a run with the prefix of a
known kind of key, a private key block, or, behind a key word, any quoted or assigned
value of whatever length and characters. Its features are its length and make-up, how its
characters change class, how much of it dictionary words cover (the corpus's own frequent
words, or a table's), the path of its document, and the words beside it. The forest is
Spark's, trained on labelled findings; everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, clean_name, regex_any

_KEY = "A-Za-z0-9+/_=-"
# Words before a secret, and prefixes of issued keys.
NAMES = "token|secret|passw|pwd|credential|api.?key|access.?key|private.?key|passphrase|auth|bearer"
PREFIXES = "AKIA|ASIA|ghp_|gho_|ghs_|github_pat_|glpat-|sk_live_|rk_live_|xox[abprs]-|AIza|SG\\.|npm_|hf_|eyJ"
# A name with a key word in it, then what assigns: at most 60 characters, as Java's look-behind
# must be bounded; a quote or sign stands right before the value, which is tested first.
_NAMED = rf"(?i:{NAMES})[A-Za-z0-9_.-]{{0,30}}[\"'`]?\s{{0,4}}(?:[=:]|=>|:=|is)\s{{0,4}}"
_BY_CONTEXT = (
    rf"(?<=[\"'`])(?<={_NAMED}[\"'`])[^\"'`\n]+(?=[\"'`])",
    rf"(?<=[=:>s]\s{{0,4}})(?<={_NAMED})[^\s\"'`,;<>]{{4,}}",
)
_BY_MAKE = (
    rf"(?<![{_KEY}])(?:{PREFIXES})[.{_KEY}]{{12,}}+",
    rf"(?<![{_KEY}])(?=[A-Za-z+/_=-]*+[0-9])[{_KEY}]{{16,}}+",
)
_BLOCK = r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----[A-Za-z0-9+/=\s]*+(?:-----END [A-Z ]{0,30}PRIVATE KEY-----)?"
CANDIDATE = "|".join((_BLOCK, *_BY_CONTEXT, *_BY_MAKE))
PLAIN = "|".join((_BLOCK, *_BY_MAKE))  # the same where no name stands before what assigns; look-behind is dear
BEFORE, AFTER = 40, 20  # characters of context
TREES, DEPTH, SEED = 20, 6, 42
LABELLED = 20_000  # distinct findings of each label at most that the forest is fitted on, the first by hash

# What a finding's features are made of.
FINDING = ("candidate", "before", "after", "path")

VOCABULARY = 300  # frequent words that make the dictionary

# Signs in paths and neighbours.
KEYWORD = rf"(?i)({NAMES})"
HARMLESS = r"(?i)(uuid|guid|commit|revision|checksum|digest|sha\d|md5|hash|order|invoice|serial|isbn|example|dummy|sample|placeholder|card|phone)"
TEST_PATH = r"(?i)(test|example|sample|fixture|mock|doc)"
CODE_PATH = r"(?i)\.(env|ya?ml|json|ini|cfg|conf|properties|py|js|ts|java|go|rb|sh)$"


def candidates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """One row per candidate: doc_id, n (1, 2, ... in its text), start (characters before
    it), candidate, before, after (its neighbours), path.

    Null and empty texts have none; every row's candidates are its own, those of repeated
    rows included. Without a path column the path is empty."""
    def either(of) -> Column:
        return F.when(F.col(text).rlike(_NAMED), of(CANDIDATE)).otherwise(of(PLAIN))

    own = docs.where(either(lambda p: F.col(text).rlike(p))).select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(path).cast("string") if path else F.lit(""), F.lit("")).alias("path"),
        either(lambda p: F.regexp_extract_all(text, F.lit(p), 0)).alias("found"),
        either(lambda p: F.split(text, p, -1)).alias("between"),
    )
    # where each stands: the lengths of all that is before it
    lengths = F.zip_with("found", F.slice("between", F.lit(1), F.size("found")), lambda a, b: F.length(a) + F.length(b))
    ends = F.aggregate(
        lengths,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("ends")),
        lambda s, x: F.struct((s["at"] + x).alias("at"), F.concat(s["ends"], F.array(s["at"] + x)).alias("ends")),
    )["ends"]
    each = own.withColumn("ends", ends).select(
        "doc_id", "path", "found", "between", "ends", F.explode(F.sequence(F.lit(1), F.size("found"))).alias("n")
    )
    i = F.col("n") - 1
    return each.select(
        "doc_id",
        F.col("n").cast("long").alias("n"),
        (F.col("ends")[i] - F.length(F.col("found")[i])).cast("long").alias("start"),
        F.col("found")[i].alias("candidate"),
        F.right(F.col("between")[i], F.lit(BEFORE)).alias("before"),
        F.left(F.col("between")[i + 1], F.lit(AFTER)).alias("after"),
        "path",
    )


def frequent_words(docs: DataFrame, text: str = "text", n: int = VOCABULARY) -> tuple[str, ...]:
    """The ``n`` most frequent words of three letters or more (ties by word): a dictionary for
    ``train``. Every text is counted; a word that all texts have is one partial row per task."""
    words = docs.select(F.explode(F.split(F.lower(text), r"\P{L}+")).alias("word")).where(F.length("word") >= 3)
    top = words.groupBy("word").count().orderBy(F.desc("count"), "word").limit(n)
    return tuple(r["word"] for r in top.collect())


def features(words: tuple[str, ...] = ()) -> dict[str, Column]:
    c = F.col("candidate")
    n = F.length(c)
    share = lambda chars: (n - F.length(F.regexp_replace(c, chars, ""))) / n
    classes = c
    for chars, sign in (("[a-z]", "a"), ("[A-Z]", "b"), ("[0-9]", "c"), ("[^abc]", "d")):
        classes = F.regexp_replace(classes, chars, sign)
    runs = F.length(F.regexp_replace(classes, r"(.)\1+", "$1"))
    to_digit = F.regexp_count(classes, F.lit("[ab]c")) + F.regexp_count(classes, F.lit("c[ab]"))
    yes = lambda x: x.cast("double")
    return {
        "length": F.log2(n),
        "lower": share("[a-z]"),
        "upper": share("[A-Z]"),
        "digit": share("[0-9]"),
        "sign": share("[+/_=-]"),
        "other": share(r"[^A-Za-z0-9+/_=\s-]"),
        "space": share(r"\s"),
        "prefix": yes(c.rlike(f"^(?:{PREFIXES})")),
        "block": yes(c.startswith("-----BEGIN")),
        "hex": yes(c.rlike("^([0-9a-f]+|[0-9A-F]+)$")),
        "distinct": F.size(F.array_distinct(F.split(c, ""))) / n,
        "class_changes": (runs - 1) / n,
        "letter_digit_changes": to_digit / n,
        "case_changes": F.regexp_count(classes, F.lit("ab|ba")) / n,
        "dictionary": share(f"(?i)({regex_any(words)})") if words else F.lit(0.0),
        "test_path": yes(F.col("path").rlike(TEST_PATH)),
        "code_path": yes(F.col("path").rlike(CODE_PATH)),
        "keyword_before": yes(F.col("before").rlike(KEYWORD)),
        "harmless_before": yes(F.col("before").rlike(HARMLESS)),
        "assigned": yes(F.col("before").rlike(r"[=:]\s*[\"'`]?$")),
        "quoted": yes(F.col("before").rlike(r"[\"'`]$") & F.col("after").rlike(r"^[\"'`]")),
        "words_before": F.size(F.filter(F.split("before", r"\s+"), lambda w: w.rlike(r"^\p{L}{2,}$"))).cast("double"),
        "words_after": F.size(F.filter(F.split("after", r"\s+"), lambda w: w.rlike(r"^\p{L}{2,}$"))).cast("double"),
    }


def _featured(found: DataFrame, words: tuple[str, ...]) -> tuple[DataFrame, str]:
    own = features(words)
    names = {k: clean_name(found, f"f_{k}") for k in own}
    vector = clean_name(found, "features")
    out = found.withColumns({names[k]: F.coalesce(v.cast("double"), F.lit(0.0)) for k, v in own.items()})
    return VectorAssembler(inputCols=list(names.values()), outputCol=vector).transform(out).drop(*names.values()), vector


class Model:
    """A fitted forest, or a constant probability, and the dictionary it was trained with."""

    def __init__(self, forest: RandomForestClassificationModel | float, words: tuple[str, ...] = ()):
        self.forest, self.words = forest, words


def train(labelled: DataFrame, words: tuple[str, ...] = ()) -> Model:
    """A forest from labelled findings: the columns of ``candidates`` and ``label`` (1: a
    secret), from a table of reviewed findings or ``by_assignment``. Findings without a
    label are not used. Equal findings count as one, weighed by their number; of more than LABELLED of a label, the first by a hash stand for all
    of that label. Where all labels of the table are one (or there is none) the answer is
    a constant: that label, and 1 (nothing is removed) without any. ``words``: the
    dictionary (see ``frequent_words``)."""
    own = labelled.where("label IS NOT NULL").select(*FINDING, (F.col("label") > 0).cast("double").alias("label"))
    own = checkpoint(own.groupBy(*FINDING, "label").agg(F.count("*").cast("double").alias("weight")))
    total = {r.label: r.w for r in own.groupBy("label").agg(F.sum("weight").alias("w")).collect()}
    if len(total) < 2:
        return Model(next(iter(total), 1.0), words)
    first = [own.where(F.col("label") == k).orderBy(F.xxhash64(*FINDING), *FINDING).limit(LABELLED) for k in sorted(total)]
    own = checkpoint(first[0].unionAll(first[1]))
    kept = {r.label: r.w for r in own.groupBy("label").agg(F.sum("weight").alias("w")).collect()}
    share = F.when(F.col("label") > 0, total[1.0] / kept[1.0]).otherwise(total[0.0] / kept[0.0])
    table, vector = _featured(own.withColumn("weight", F.col("weight") * share), words)
    forest = RandomForestClassifier(featuresCol=vector, labelCol="label", weightCol="weight", numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    return Model(forest.fit(table.select("label", "weight", vector)), words)


def scored(found: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """``candidates`` with ``probability`` and ``secret`` (probability at or above the threshold)."""
    if isinstance(model.forest, float):
        out = found.withColumn("probability", F.lit(model.forest))
    else:
        table, vector = _featured(found, model.words)
        assert model.forest.getFeaturesCol() == vector
        out = model.forest.transform(table).withColumn("probability", F.round(vector_to_array("probability")[1], 9))
        out = out.select(*found.columns, "probability")
    return out.withColumn("secret", F.col("probability") >= threshold)


def scanned(docs: DataFrame, model: Model, threshold: float = 0.5, **names) -> DataFrame:
    """``scored`` candidates of ``docs``."""
    return scored(candidates(docs, **names), model, threshold)


def evaluated(labelled: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """One row: precision and recall on labelled findings that the model has not seen, and how many there were."""
    own = scored(labelled.where("label IS NOT NULL"), model, threshold)
    hit = F.count_if(F.col("secret") & (F.col("label") > 0))
    return own.agg(
        F.count("*").alias("findings"), F.count_if(F.col("label") > 0).alias("secrets"),
        (hit / F.nullif(F.count_if("secret"), F.lit(0))).alias("precision"),
        (hit / F.nullif(F.count_if(F.col("label") > 0), F.lit(0))).alias("recall"),
    )


def by_assignment(found: DataFrame) -> DataFrame:
    """Labels where no reviewed findings exist: 1 for a value in quotes that is assigned to
    a name with a key word, 0 for a candidate of digits alone or beside a harmless word,
    else none."""
    assigned = F.col("before").rlike(rf"{_NAMED}[\"'`]$") & F.col("after").rlike(r"^[\"'`]")
    digits = F.col("candidate").rlike(r"^[0-9_+/=-]+$") | F.col("before").rlike(HARMLESS)
    return found.withColumn("label", F.when(assigned, 1).when(digits, 0))
