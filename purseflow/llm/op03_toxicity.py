"""Toxicity by a weighted finite-state grammar over clauses.

Words are read as symbols: insult, threat, target, negation, reporting verb, or other. Small
transducers follow one aspect each (is a negation near? is speech being reported? was a
target named? was a threat uttered?); their composition is one deterministic machine that
reads a clause and emits what it matched: an asserted, aimed, negated or reported insult, an
aimed threat. A document's score weighs these matches, never a word by itself.

Insults are learned: words, and stems of five letters, that stand in many different contexts
(word before, word after) of toxic training documents and hardly ever in the others.
Counting contexts on both sides keeps a text with thousands of copies from turning its words
into insults, or the insults it quotes into ordinary words.
The weights of the matches are a logistic regression. Counts cover all labelled training
documents; the regression is fitted on at most ``FIT_ROWS`` of them, those whose doc_id
hashes lowest. Labels of held-out documents are never read, nor are lang, source or doc_id.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import broadcast_if_small
from .registry import query, table
from .tables import Workspace

FOLDS = 5
FIT_ROWS = 20_000
MIN_CONTEXTS = 5
MIN_LOG_ODDS = 2.5
STEM = 5
SLICES = 8  # of so many parts of all contexts one is counted first; it rules out ordinary words
SEEN = 200_000  # contexts a worker holds before it passes them on
BROADCAST_LABELS = 2_000_000

# closed word classes, fixed values
THREATS = frozenset(
    "kill hurt destroy beat burn shoot stab crush töten umbringen verletzen schlagen tuer "
    "frapper brûler blesser matar golpear quemar herir".split()
)
TARGETS = frozenset(
    "you your yours yourself they them their he him she her we us du dich dir ihr euch sie "
    "tu te toi vous ils elles ellos ellas ustedes usted vosotros".split()
)
NEGATIONS = frozenset("not no never nobody nicht kein keine keinen nie niemals ne pas jamais nunca jamás".split())
REPORTS = frozenset(
    "said says say quoted reported wrote claimed sagt sagte schrieb meldete dit disait écrit "
    "rapporte dijo dice escribió".split()
)

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
SYMBOLS = range(6)

_CLAUSE = re.compile(r"[.,;:!?\n|]+")
_EDGES = "\"'()[]{}<>«»„“”‚‘’*_-#.,;:!?|"

State = int
Step = Callable[[State, int], State]


class Transducer:
    """A deterministic machine: a step function and what a symbol emits in a state."""

    def __init__(self, step: Step, emit: Callable[[State, int], frozenset[str]]) -> None:
        self.step, self.emit = step, emit


NOTHING: frozenset[str] = frozenset()
#: an insult or threat at most three words after a negation is negated
negation = Transducer(
    lambda s, x: 3 if x == NEGATION else max(s - 1, 0),
    lambda s, x: frozenset({"negated"}) if s and x in (INSULT, THREAT) else NOTHING,
)
#: what follows a reporting verb in its clause is somebody else's speech
reported = Transducer(
    lambda s, x: 1 if x == REPORT else s,
    lambda s, x: frozenset({"reported"}) if s and x in (INSULT, THREAT) else NOTHING,
)
#: an insult or threat is aimed if a target stands before it, or right behind it
aimed = Transducer(
    lambda s, x: 1 if x == TARGET else (2 if x in (INSULT, THREAT) and s != 1 else (1 if s == 1 else 0)),
    lambda s, x: frozenset({"aimed"})
    if (s == 1 and x in (INSULT, THREAT)) or (s == 2 and x == TARGET)
    else NOTHING,
)
threat = Transducer(lambda s, x: s, lambda s, x: frozenset({"threat"}) if x == THREAT else NOTHING)
insult = Transducer(lambda s, x: s, lambda s, x: frozenset({"insult"}) if x == INSULT else NOTHING)


def compose(*parts: Transducer) -> tuple[list[list[int]], list[list[frozenset[str]]]]:
    """The product machine as tables: next state and joint emission by state and symbol."""
    start = (0,) * len(parts)
    number, todo = {start: 0}, [start]
    after: list[list[int]] = []
    emitted: list[list[frozenset[str]]] = []
    for state in todo:
        row, said = [], []
        for x in SYMBOLS:
            new = tuple(p.step(s, x) for p, s in zip(parts, state))
            if new not in number:
                number[new] = len(number)
                todo.append(new)
            row.append(number[new])
            said.append(frozenset().union(*(p.emit(s, x) for p, s in zip(parts, state))))
        after.append(row)
        emitted.append(said)
    return after, emitted


NEXT, EMIT = compose(insult, threat, negation, reported, aimed)

FEATURES = ["asserted", "negated", "reported", "aimed", "threats", "clauses", "strongest"]


class Lexicon:
    """Learned insults: weight by word and by stem."""

    def __init__(self, words: dict[str, float], stems: dict[str, float]) -> None:
        self.words, self.stems = words, stems

    def weight(self, word: str) -> float:
        found = self.words.get(word)
        if found is None and len(word) > STEM:
            found = self.stems.get(word[:STEM])
        return found or 0.0

    def symbol(self, word: str) -> tuple[int, float]:
        weight = self.weight(word)
        if weight:
            return INSULT, weight
        if word in THREATS:
            return THREAT, MIN_LOG_ODDS
        if word in TARGETS:
            return TARGET, 0.0
        if word in NEGATIONS:
            return NEGATION, 0.0
        return (REPORT, 0.0) if word in REPORTS else (OTHER, 0.0)


def matches(text: str | None, lexicon: Lexicon) -> list[float]:
    """What the grammar matches in a whole text, as the features of the regression."""
    out = dict.fromkeys(FEATURES, 0.0)
    text = (text or "").lower()
    loaded = {
        w for w in set(text.split()) if lexicon.weight(w.strip(_EDGES)) or w.strip(_EDGES) in THREATS
    }
    if loaded:
        for clause in _CLAUSE.split(text):
            words = clause.split()
            if loaded.isdisjoint(words) and not any(
                lexicon.weight(w.strip(_EDGES)) or w.strip(_EDGES) in THREATS for w in words
            ):
                continue
            state, strength = 0, 0.0
            for word in words:
                symbol, weight = lexicon.symbol(word.strip(_EDGES))
                said = EMIT[state][symbol]
                state = NEXT[state][symbol]
                if "negated" in said:
                    out["negated"] += weight
                elif "reported" in said:
                    out["reported"] += weight
                elif "insult" in said:
                    out["asserted"] += weight
                    strength += weight
                elif "threat" in said and "aimed" in said:
                    out["threats"] += weight
                    strength += weight
                if "aimed" in said:
                    out["aimed"] += 1
            if strength:
                out["clauses"] += 1
                out["strongest"] = max(out["strongest"], strength)
    return [math.log1p(out[f]) for f in FEATURES]


def held_out(doc_id: Column, folds: int = FOLDS) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % folds == 0


def _training_labels(labels: DataFrame, folds: int) -> DataFrame:
    """One label per training document; held-out documents and null labels are left out."""
    return (
        labels.select(F.col("doc_id").cast("long").alias("label_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("label_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("label_id"), folds))
        .groupBy("label_id")
        .agg(F.max("toxic").alias("toxic"))
    )


def _entries(words: list[str]) -> Iterator[tuple[str, int]]:
    """Each word and the stem of each longer word, with the word's place; a stem ends in an asterisk."""
    for i, word in enumerate(words):
        if word:
            yield word, i
            if len(word) > STEM:
                yield word[:STEM] + "*", i


def _evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(entry, context, toxic): all contexts in toxic documents, those of one slice in the others."""
    for batch in batches:
        seen: set[tuple[str, int, bool]] = set()
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            words = [w.strip(_EDGES) for w in (text or "").lower().split()]
            around = ["", *words, ""]
            for entry, i in _entries(words):
                context = _stable(around[i] + " " + around[i + 2])
                if toxic or _first_slice(context):
                    seen.add((entry, context, bool(toxic)))
            if len(seen) >= SEEN:
                yield _evidence_rows(seen)
                seen = set()
        yield _evidence_rows(seen)


def _evidence_rows(seen: set[tuple[str, int, bool]]) -> pa.RecordBatch:
    columns = list(zip(*seen)) or [[]] * 3
    kinds = [pa.string(), pa.int64(), pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["entry", "context", "toxic"])


def _other_slices(entries: frozenset[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(entry, context, toxic) of these entries for the contexts that ``_evidence`` left out."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: set[tuple[str, int, bool]] = set()
            for text in batch.column("text").to_pylist():
                words = [w.strip(_EDGES) for w in (text or "").lower().split()]
                around = ["", *words, ""]
                for entry, i in _entries(words):
                    if entry in entries:
                        context = _stable(around[i] + " " + around[i + 2])
                        if not _first_slice(context):
                            seen.add((entry, context, False))
                if len(seen) >= SEEN:
                    yield _evidence_rows(seen)
                    seen = set()
            yield _evidence_rows(seen)

    return rows


def _first_slice(context: int) -> bool:
    return (context >> 1) % SLICES == 0


def _stable(text: str) -> int:
    """A hash that is the same in every process; never 0."""
    import xxhash

    return xxhash.xxh64_intdigest(text.encode("utf-8", "replace")) >> 2 | 1


class Model:
    def __init__(self, lexicon: Lexicon, beta: list[float]) -> None:
        self.lexicon, self.beta = lexicon, beta

    def score(self, text: str | None) -> float:
        z = self.beta[0] + sum(b * x for b, x in zip(self.beta[1:], matches(text, self.lexicon)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _fit(x: np.ndarray, y: np.ndarray, penalty: float = 0.1) -> list[float]:
    """Logistic regression with a ridge penalty, by Newton's method."""
    x = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(x.shape[1])
    ridge = np.eye(len(beta)) * penalty
    ridge[0, 0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ beta)
        beta = beta + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return beta.tolist()


def train(documents: DataFrame, labels: DataFrame, folds: int = FOLDS) -> Model:
    """Learn the lexicon and the weights from labelled documents outside the held-out fold."""
    work = Workspace(documents, "toxicity")
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = work.put(_training_labels(labels, folds))
    totals = known.agg(F.count(F.lit(1)), F.sum("toxic")).first()
    n, positive = totals[0], totals[1] or 0
    if not n:
        return Model(Lexicon({}, {}), [-30.0] + [0.0] * len(FEATURES))
    labelled = docs.join(broadcast_if_small(known, BROADCAST_LABELS), F.col("doc_id") == F.col("label_id"))
    kind = "entry string, context long, toxic boolean"
    counts = (
        labelled.select("text", "toxic").mapInArrow(_evidence, kind)
        .distinct()
        .groupBy("entry")
        .agg(F.sum(F.col("toxic").cast("long")).alias("toxic"), F.sum((~F.col("toxic")).cast("long")).alias("clean"))
        .where(F.col("toxic") >= MIN_CONTEXTS)
    )
    # the share of clean documents scales their contexts to the toxic ones
    share = max(positive, 1) / max(n - positive, 1)
    odds = F.log(F.col("toxic") + 0.5) - F.log((F.col("clean") + 0.5) * share)
    # contexts of one slice are no more than all: who fails by them fails by all
    likely = {r["entry"]: r for r in counts.where(odds >= MIN_LOG_ODDS).collect()}
    more = (
        labelled.where("toxic = 0").select("text").mapInArrow(_other_slices(frozenset(likely)), kind)
        .distinct().groupBy("entry").agg(F.count(F.lit(1)).alias("n"))
    )
    clean = {r["entry"]: r["n"] for r in more.collect()} if likely else {}
    best = {
        e: math.log(r["toxic"] + 0.5) - math.log((r["clean"] + clean.get(e, 0) + 0.5) * share)
        for e, r in sorted(likely.items())
    }
    best = {e: odds for e, odds in best.items() if odds >= MIN_LOG_ODDS}
    lexicon = Lexicon(
        {e: odds for e, odds in best.items() if not e.endswith("*")},
        {e[:-1]: odds for e, odds in best.items() if e.endswith("*")},
    )
    sample = known.orderBy(F.xxhash64("label_id"), "label_id").limit(FIT_ROWS)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [matches(t, lexicon) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.list_(pa.float64())), batch.column("toxic").cast(pa.int32())], names=["x", "toxic"]
            )

    fitted = (
        docs.join(F.broadcast(sample), F.col("doc_id") == F.col("label_id"))
        .select("text", "toxic")
        .mapInArrow(features, "x array<double>, toxic int")
        .groupBy("x", "toxic")
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    if not fitted:
        return Model(lexicon, [-30.0] + [0.0] * len(FEATURES))
    fitted.sort(key=lambda r: (r["x"], r["toxic"]))
    weight = np.repeat(np.arange(len(fitted)), [r["n"] for r in fitted])
    x = np.array([r["x"] for r in fitted])[weight]
    y = np.array([1.0 if r["toxic"] else 0.0 for r in fitted])[weight]
    return Model(lexicon, _fit(x, y))


def score(documents: DataFrame, model: Model) -> DataFrame:
    """``documents`` with a column ``score`` from 0 to 1; an own column of that name is replaced."""

    @F.pandas_udf("double")
    def scored(texts):
        return texts.map(model.score, na_action=None).astype(float)

    return documents.withColumn("score", scored(F.col("text")))


def toxicity(documents: DataFrame, labels: DataFrame, folds: int = FOLDS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``documents``.

    Null and empty texts match nothing and get the score of a text without matches. A null
    doc_id is never held out. Repeated rows are all scored; of several labels of a document
    the highest counts. Without any label every score is 0 (to ten digits). Other columns are
    ignored.
    """
    model = train(documents, labels, folds)
    scored = score(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model)
    return scored.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id"), folds), F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents, learned from the labels outside one fold of five."""
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
