"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements and one long with a bit per failed rule; a policy
is a versioned mask of rules, so a policy is applied, compared or ablated by bitwise operations, without reading a text again.

The insults of other languages, and new ones, are learned: ``learn`` compares, language by language, the beginnings of words (4 to 9 letters) in
documents labelled toxic and clean, and keeps those that are mostly of toxic ones and in more toxic texts than chance would
explain. It reads a bounded sample: of each language and label, the ``SAMPLE`` documents with the smallest md5 of the id (fewer with so many
languages that all would have more than ``SAMPLE_ALL``); whole texts, equal texts once. Labels of no document, null ids and other
labels than 0 and 1 are left out; documents without a language make up one of their own; without toxic documents nothing is
learned. The rules then cover all documents, whatever their language.

Odd rows: a null text counts as an empty one (no words); each row is judged by itself, so repeated rows and ids get equal
results; an empty table gives an empty ledger; a very long text is measured whole. Columns of the input named like the ledger's are not read.
"""

from __future__ import annotations

import string
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from picsel.llm.common import SPACE, stage, utf8

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_lower", "n_bangs",
            "n_abusive", "n_learned")
SYMBOLS = b"#*$%&|<>"
PUNCTUATION = string.punctuation.encode()
#: Insults that count as abusive words (fixed values).
ABUSIVE = ("asshole", "bastard", "bitch", "clown", "cretin", "disgusting", "dumbass", "fool", "freak", "garbage", "idiot", "idiotic",
           "imbecile", "jerk", "loser", "lowlife", "moron", "moronic", "nitwit", "pathetic", "pig", "psycho", "retard", "scum",
           "scumbag", "stupid", "trash", "vermin", "worthless")
_ABUSIVE = frozenset(w.encode() for w in ABUSIVE)

#: Labelled documents that are learned from, by label (0: clean, 1: toxic): of each language, and of all together.
SAMPLE, SAMPLE_ALL = {0: 8000, 1: 2000}, {0: 80_000, 1: 20_000}
SLICES = 256
#: Lengths of stems.
LENGTHS = range(4, 10)
#: A stem must be in so many toxic texts that the chance of drawing as many among its language's texts is under 10 ** -SURPRISE, and
#: in one of RARE toxic texts at least.
SURPRISE, RARE = 5, 250

#: Rules in bit order: name and the SQL condition, over measurements, under which a document fails. New rules are appended,
#: bits never move.
RULES = (
    ("too_short", "{n_words} < 50"),
    ("repeated_windows", "100 * {n_repeat_words} > 50 * {n_words}"),
    ("symbols", "10 * {n_symbols} > {n_words}"),
    ("duplicate_lines", "10 * {n_dup_lines} > 3 * {n_lines}"),
    ("shouting", "2 * {n_upper} > {n_upper} + {n_lower}"),
    ("exclamations", "10 * {n_bangs} > {n_words}"),
    ("word_length", "{word_chars} < 2 * {n_words} or {word_chars} > 16 * {n_words}"),
    ("abusive", "{n_abusive} >= 2 and 1000 * {n_abusive} > {n_words}"),
    ("learned_abuse", "{n_learned} >= 2 and 100 * {n_learned} > {n_words}"),
    # duplicate lines count by the text they repeat: a fifth of the words, twice, so that a short line that opens and closes a text
    # does not reject it
    ("duplicate_text", "10 * {n_dup_lines} > 3 * {n_lines} and 5 * {n_repeat_words} > 2 * {n_words}"),
)
BASE = ("too_short", "repeated_windows")
#: Versioned policies: the rules whose failure rejects a document.
POLICIES = {
    "base": BASE,
    "v1": BASE + ("symbols", "duplicate_lines", "shouting", "exclamations"),
    "v2": tuple(name for name, _ in RULES[:8]),
    "v3": tuple(name for name, _ in RULES[:9]),
    "v4": tuple(name for name, _ in RULES[:10] if name != "duplicate_lines"),
}
CURRENT = "v4"


def mask(rules) -> int:
    names = [name for name, _ in RULES]
    return sum(1 << names.index(r) for r in rules)


def _repeats(words: list[bytes]) -> tuple[int, dict[bytes, int]]:
    """Words inside 3-word windows that occur twice or more, and the word numbers."""
    ids: dict[bytes, int] = {}
    if len(words) < 4:
        for w in words:
            ids.setdefault(w, len(ids))
        return 0, ids
    x = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    n = len(ids)
    window = x[:-2] * n + x[1:-1]
    if n > 1 << 20:  # keeps the product below 2 ** 63
        window = np.unique(window, return_inverse=True)[1].astype(np.int64)
        window = window * n + x[2:]
    else:
        window = window * n + x[2:]
    _, inverse, counts = np.unique(window, return_inverse=True, return_counts=True)
    again = counts[inverse] > 1
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k:len(words) - 2 + k] |= again
    return int(covered.sum()), ids


def stems(word: str) -> set[str]:
    """The beginnings of a word without the punctuation around it, A-Z lower-cased."""
    word = word.strip(string.punctuation).translate(_TO_LOWER)
    return {word[:k] for k in LENGTHS} if word else set()


def _learned(words: list[bytes], lexicon: Lexicon) -> list[bytes]:
    """Those of the distinct words that begin with a learned stem."""
    if not words or not lexicon.stems:
        return []
    texts = b"\n".join(words).lower().decode("utf-8").split("\n")
    heads = lexicon.heads
    out = []
    for word, text in zip(words, texts):
        text = text.strip(string.punctuation)
        if text[:LENGTHS[0]] in heads and any(text[:k] in lexicon.stems for k in LENGTHS):
            out.append(word)
    return out


class Lexicon:
    """Learned stems, and their first letters to look up first."""

    def __init__(self, stems=()):
        self.stems = frozenset(stems)
        self.heads = frozenset(s[:LENGTHS[0]] for s in self.stems)


_NONE = Lexicon()
_TO_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
_UPPER, _LOWER = string.ascii_uppercase.encode(), string.ascii_lowercase.encode()


def measure(text: str | None, lexicon: Lexicon = _NONE) -> tuple[int, ...]:
    """The ``MEASURES`` of one text."""
    raw = utf8(text)
    words = raw.split()
    repeats, ids = _repeats(words)
    dup = lines = 0
    seen: set[bytes] = set()
    for line in raw.split(b"\n"):
        if line.strip(SPACE):
            lines += 1
            if line in seen:
                dup += 1
            seen.add(line)
    abusive = [w for w in ids if w.strip(PUNCTUATION).lower() in _ABUSIVE]
    learned = _learned(list(ids), lexicon)
    times = Counter(words) if abusive or learned else {}
    gone = lambda chars: len(raw) - len(raw.translate(None, chars))
    return (len(words), len(text or "") - gone(SPACE), gone(SYMBOLS), dup, repeats, lines, gone(_UPPER), gone(_LOWER), raw.count(b"!"),
            sum(times[w] for w in abusive), sum(times[w] for w in learned))


def _count_stems(it):
    """Documents and occurrences of each stem in a language's toxic texts, and occurrences in the clean ones, summed over some batches."""
    seen: dict[tuple[str, str], list[int]] = {}

    def flush():
        rows = [(*s, *n) for s, n in seen.items()]
        for a in range(0, len(rows), 1 << 16):
            lang, stem, *counts = zip(*rows[a:a + (1 << 16)])
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(stem, pa.string())] + [pa.array(c, pa.int64()) for c in counts],
                                             names=["lang", "stem", "docs", "toxic", "clean"])

    for batch in it:
        for text, lang, toxic in zip(*[batch.column(c).to_pylist() for c in range(3)]):
            own: Counter = Counter()
            for word, n in Counter(utf8(text).split()).items():
                for s in stems(word.decode("utf-8")):
                    own[s] += n
            for s, n in own.items():
                x = seen.setdefault((lang, s), [0, 0, 0])
                x[0] += toxic
                x[2 - toxic] += n
            if len(seen) > 1 << 20:
                yield from flush()
                seen.clear()
    yield from flush()


def _smallest(rows: DataFrame) -> DataFrame:
    """Of ``id, lang, toxic, hash``, the sample of each language and label: the rows with the smallest hash.

    Only hashes that can be among the smallest (half as many again as needed, on average) are read on. Should they be too few, as where an id
    repeats, all are. The range of hashes is cut into slices; whole slices are taken or left by their counts, and only rows of a slice are
    ranked against each other, so no task gets a whole language.
    """
    spark, part = rows.sparkSession, F.conv(F.substring("hash", 1, 12), 16, 10).cast("long")
    counts = {(r.lang, r.toxic): r["count"] for r in rows.groupBy("lang", "toxic").count().collect()}  # two rows a language
    size = {t: max(1, min(SAMPLE[t], SAMPLE_ALL[t] // max(1, len({lang for lang, _ in counts})))) for t in SAMPLE}
    cuts = {(lang, t): 1 << 48 if n <= 1.5 * size[t] else int(1.5 * size[t] / n * (1 << 48)) for (lang, t), n in counts.items()}

    def near() -> DataFrame:
        table = spark.createDataFrame([(lang, t, cut, size[t]) for (lang, t), cut in cuts.items()], "lang string, toxic long, cut long, size long")
        return rows.join(F.broadcast(table), ["lang", "toxic"]).filter(part <= F.col("cut"))

    if any(cut < 1 << 48 for cut in cuts.values()):
        found = {(r.lang, r.toxic): r["count"] for r in near().groupBy("lang", "toxic").count().collect()}
        cuts = {k: cut if found.get(k, 0) >= min(size[k[1]], counts[k]) else 1 << 48 for k, cut in cuts.items()}
    rows_near = near().withColumn("slice", F.expr(f"CAST(conv(substring(hash, 1, 12), 16, 10) AS BIGINT) * {SLICES} div (cut + 1)"))
    before = Window.partitionBy("lang", "toxic").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = rows_near.groupBy("lang", "toxic", "slice").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    # SLICES rows a language and label at most
    inside = rows_near.join(F.broadcast(slices.drop("n")), ["lang", "toxic", "slice"]).filter(F.col("before") < F.col("size"))
    place = F.col("before") + F.row_number().over(Window.partitionBy("lang", "toxic", "slice").orderBy("hash", "id"))
    return inside.withColumn("place", place).filter(F.col("place") <= F.col("size")).select("id", "lang", "toxic")


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Lexicon:
    """The stems that toxic texts of a language's sample have surprisingly often, and 85 % of whose occurrences are in toxic texts.

    ``labels`` has the columns ``doc_id`` and ``toxic`` (0 or 1). The sample is drawn from the distinct labels of documents with a text,
    so neither labels of documents that ``docs`` lacks nor repeated labels use up its places. ``docs`` need not have ``lang_col``.
    """
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("")) if lang_col in docs.columns else F.lit("")
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), lang.alias("lang")).filter("text is not null")
    rows = labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("long").alias("toxic"))
    rows = rows.filter("id is not null and toxic in (0, 1)").distinct().join(source.select("id", "lang").distinct(), "id")
    rows = stage(rows.withColumn("hash", F.md5(F.col("id").cast("string"))), "labelled")
    # at most SAMPLE_ALL ids are broadcast, or one of each language and label
    texts = stage(source.join(F.broadcast(_smallest(rows)), ["id", "lang"]).select("text", "lang", "toxic").distinct(), "sample")
    counted = texts.mapInArrow(_count_stems, "lang string, stem string, docs long, toxic long, clean long")
    total = counted.groupBy("lang", "stem").agg(F.sum("docs").alias("docs"), F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    sizes = texts.groupBy("lang").agg(F.count("*").alias("n"), F.sum("toxic").alias("n_toxic"))
    found = total.filter("docs > 0").join(F.broadcast(sizes), "lang").filter(
        (F.col("docs") * F.log10(F.try_divide("n", "n_toxic")) >= SURPRISE) & (RARE * F.col("docs") >= F.col("n_toxic"))
        & (20 * F.col("toxic") >= 17 * (F.col("toxic") + F.col("clean"))))
    return Lexicon(r.stem for r in found.select("stem").distinct().collect())  # some of a bounded sample's


def with_measures(docs: DataFrame, text_col: str = "text", prefix: str = "__picsel_q_", lexicon: Lexicon = _NONE) -> DataFrame:
    """``docs`` with one column per measurement, named ``prefix`` + name."""
    fields = [f for f in docs.schema.fields if not f.name.startswith(prefix)]
    source = docs.select(*[F.col(f"`{f.name}`") for f in fields])
    at = [f.name for f in fields].index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)  # short strings of a bounded sample
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + [f"{prefix}{m} long" for m in MEASURES])

    def run(it):
        for batch in it:
            got = np.array([measure(t, shared.value) for t in batch.column(at).to_pylist()], np.int64).reshape(-1, len(MEASURES))
            yield pa.RecordBatch.from_arrays(batch.columns + [pa.array(np.ascontiguousarray(got[:, i])) for i in range(len(MEASURES))],
                                             names=batch.schema.names + [prefix + m for m in MEASURES])

    return source.mapInArrow(run, schema)


def conditions(prefix: str = "") -> list[str]:
    """The rules' SQL conditions over columns named ``prefix`` + measurement."""
    names = {m: f"{prefix}{m}" for m in MEASURES}
    return [condition.format(**names) for _, condition in RULES]


def failure_bits(prefix: str = "") -> Column:
    """One long: bit i is set if rule i fails."""
    out = F.lit(0).cast("long")
    for i, condition in enumerate(conditions(prefix)):
        out = out.bitwiseOR(F.when(F.expr(condition), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return out


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lexicon: Lexicon = _NONE) -> DataFrame:
    """``doc_id``, the measurements and ``failed`` (the failure bits) of every row."""
    found = with_measures(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")),
                          lexicon=lexicon)
    return found.select("doc_id", *[F.col(f"__picsel_q_{m}").alias(m) for m in MEASURES]).withColumn("failed", failure_bits())


def passes(policy: str = CURRENT, failed: Column | str = "failed") -> Column:
    failed = F.col(failed) if isinstance(failed, str) else failed
    return failed.bitwiseAND(F.lit(mask(POLICIES[policy])).cast("long")) == 0


def ablation(book: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Per rule of a policy: documents that fail it, that fail only it, and that stay if it is dropped.

    The ledger is first counted by its failure bits, at most ``2 ** len(RULES)`` rows.
    """
    bits = F.col("failed").bitwiseAND(F.lit(mask(POLICIES[policy])).cast("long"))
    histogram = book.groupBy(bits.alias("bits")).agg(F.count("*").alias("n"))
    rules = book.sparkSession.createDataFrame([(r, mask([r])) for r in POLICIES[policy]], "rule string, bit long")
    count = lambda cond: F.sum(F.when(cond, F.col("n")).otherwise(0)).alias
    one, all_bits = F.col("bit"), F.col("bits")
    # a rule meets every failure pattern: a handful of rows on both sides
    return histogram.join(F.broadcast(rules), F.lit(True)).groupBy("rule").agg(
        count(all_bits.bitwiseAND(one) != 0)("n_failed"), count(all_bits == one)("n_only_this"),
        count((all_bits == 0) | (all_bits == one))("n_kept_without"))


def keep_good(docs: DataFrame, policy: str = CURRENT, lexicon: Lexicon = _NONE) -> DataFrame:
    """The rows of ``docs`` that the policy accepts, with their own columns."""
    return with_measures(docs, lexicon=lexicon).filter(passes(policy, failure_bits("__picsel_q_"))).select(*[F.col(f"`{c}`") for c in docs.columns])
