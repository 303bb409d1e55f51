"""Operator 3: secret scans with a randomness test battery, in DataFrame functions only.

Method. Three fixed patterns give the base spans. Beside them, long runs of encoding characters are tested for looking like
random draws: the encoding (digits, hex, base32, letters, base36, base62, base64) is inferred from the characters used, and a
chi-squared test of its alphabet's uniformity, a runs test and a serial-correlation test are joined by Fisher's method into one
p-value that is uniform for random strings and near 0 for words. The corpus' p-values are counted by length class and p-value
class; in each length class the share of random strings follows from the upper half, where words don't reach, and the least
threshold whose estimated share of false discoveries is at most FALSE_SHARE applies. Classes where no threshold does add nothing.

Scale. Two passes over the texts and no shuffle but that of the class counts, whose number is fixed. A document's spans
stay in its row, and the work on them is near their number, as positions come from sums by block (``folds``).

Cases. A null or empty text has no spans. Repeated rows each keep theirs. Positions are code points, ends exclusive. Extra columns pass
through, but for one named like the result column, which wins; ``redact`` keeps all columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.folds import before, let
from tidemark.llm.shared import without

#: The base patterns, which group of each counts how many characters at least.
ASSIGN = r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "random")
LEAST_ASSIGNED = 8

#: What is tested for randomness, and for which share of false discoveries.
RUN = r"[A-Za-z0-9+/_-]{20,}"
LEAST_RUN, LENGTH_CLASSES, FALSE_SHARE = 20, 8, 0.05
THRESHOLDS = (0.001, 0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.5)
#: Encodings in the order tried: pattern of the whole run, alphabet.
_DIGITS, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
_UPPER = _LOWER.upper()
ENCODINGS = (
    ("^[0-9]+$", _DIGITS),
    ("^[0-9a-f]+$", _DIGITS + "abcdef"),
    ("^[0-9A-F]+$", _DIGITS + "ABCDEF"),
    ("^[a-z]+$", _LOWER),
    ("^[A-Z]+$", _UPPER),
    ("^[A-Z2-7]+$", _UPPER + "234567"),
    ("^[0-9a-z]+$", _DIGITS + _LOWER),
    ("^[A-Za-z]+$", _UPPER + _LOWER),
    ("^[A-Za-z0-9]+$", _UPPER + _LOWER + _DIGITS),
    ("^[A-Za-z0-9+/]+$", _UPPER + _LOWER + _DIGITS + "+/"),
)
_OTHER = _UPPER + _LOWER + _DIGITS + "-_+/"

#: A character that stands for a match's ends, and what a text's own such characters become; no pattern matches either.
_MARK, _MASK = "", ""


def _no_spans(kind: str = "start int, end int, part string") -> Column:
    return F.lit(None).cast(f"array<struct<{kind}>>")


def matches(text: str, pattern: str) -> Column:
    """Array of (start, end, part) of a pattern's leftmost non-overlapping matches; null where there are none."""
    t = F.col(text)
    clean = F.when(F.contains(t, F.lit(_MARK)), F.translate(t, _MARK, _MASK)).otherwise(t)
    parts = F.split(F.regexp_replace(clean, f"(?:{pattern})", f"{_MARK}$0{_MARK}"), _MARK)

    spans = lambda p, at: F.zip_with(p, at, lambda part, a: F.struct(a.alias("start"), (a + F.length(part)).alias("end"), part.alias("part")))
    found = let(parts, lambda p: F.filter(spans(p, before(F.transform(p, lambda x: F.length(x)), F.lit(0), lambda x, y: x + y)), lambda _, i: i % 2 == 1))
    return F.when(t.rlike(pattern), found).otherwise(_no_spans())


def _tail(z: Column) -> Column:
    """P(Z > z) of a standard normal, by a logistic approximation."""
    return 1 / (1 + F.exp(F.least(F.lit(500.0), 1.5976 * z + 0.070565 * z * z * z)))


def _both_tails(z: Column) -> Column:
    return F.least(F.lit(1.0), 2 * _tail(F.abs(z)))


def _alphabet(run: Column) -> Column:
    out = F.lit(_OTHER)
    for pattern, alphabet in reversed(ENCODINGS):
        out = F.when(run.rlike(pattern), F.lit(alphabet)).otherwise(out)
    return out


def randomness(run: Column) -> Column:
    """Fisher's joint p-value of the three tests that ``run`` is drawn evenly and independently from its encoding's alphabet."""

    def by_alphabet(alphabet: Column) -> Column:
        n, k = F.length(run).cast("double"), F.length(alphabet).cast("double")
        squares = F.aggregate(F.split(alphabet, ""), F.lit(0.0), lambda acc, c: acc + F.pow(n - F.length(F.replace(run, c, F.lit(""))), F.lit(2)))
        free = k - 1
        uniform = _tail((F.pow((k / n * squares - n) / free, F.lit(1 / 3)) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free)))
        places = F.transform(F.split(run, ""), lambda c: F.instr(alphabet, c).cast("double") - 1)

        def by_places(x: Column) -> Column:
            high = F.aggregate(x, F.lit(0.0), lambda acc, v: acc + F.when(2 * v >= k, 1.0).otherwise(0.0))
            steps = F.zip_with(F.slice(x, F.lit(1), F.size(x) - 1), F.slice(x, F.lit(2), F.size(x) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
            changes = F.aggregate(steps, F.lit(0.0), lambda acc, s: acc + F.when((2 * s["a"] >= k) != (2 * s["b"] >= k), 1.0).otherwise(0.0))
            mean = F.aggregate(x, F.lit(0.0), lambda acc, v: acc + v) / n

            def by_counts(v: Column) -> Column:
                due = 2 * v["high"] * (n - v["high"]) / n + 1
                spread = (due - 1) * (due - 2) / (n - 1)
                runs = F.when(spread > 0, _both_tails((v["changes"] + 1 - due) / F.sqrt(spread))).otherwise(1e-9)
                along = F.aggregate(steps, F.lit(0.0), lambda acc, s: acc + (s["a"] - v["mean"]) * (s["b"] - v["mean"]))
                around = F.aggregate(x, F.lit(0.0), lambda acc, p: acc + (p - v["mean"]) * (p - v["mean"]))
                serial = F.when(around > 0, _both_tails(along / around * F.sqrt(n))).otherwise(1e-9)
                floor = F.lit(1e-12)
                half = -(F.ln(F.greatest(uniform, floor)) + F.ln(F.greatest(runs, floor)) + F.ln(F.greatest(serial, floor)))
                return let(half, lambda h: F.exp(-h) * (1 + h + h * h / 2))

            return let(F.struct(high.alias("high"), changes.alias("changes"), mean.alias("mean")), by_counts)

        return let(places, by_places)

    return let(_alphabet(run), by_alphabet)


def _length_class(n: Column) -> Column:
    return F.least(F.lit(LENGTH_CLASSES - 1), F.floor(2 * F.log2(n / LEAST_RUN))).cast("int")


def candidates(text: str) -> Column:
    """(start, end, p, class) of each long run of encoding characters; null where there are none."""
    return F.transform(matches(text, RUN), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), randomness(x["part"]).alias("p"), _length_class(x["end"] - x["start"]).alias("class")))


def thresholds(docs: DataFrame) -> list[float]:
    """The least p-value that counts as random, by length class; above 1 where none does."""
    grade = sum((F.when(F.col("r.p") > t, 1).otherwise(0) for t in THRESHOLDS), F.lit(0))
    rows = docs.select(F.explode(candidates("text")).alias("r")).groupBy(F.col("r.class").alias("class"), grade.alias("grade")).count().collect()  # LENGTH_CLASSES * (THRESHOLDS + 1) rows at most
    out = []
    for c in range(LENGTH_CLASSES):
        above = [sum(r["count"] for r in rows if r["class"] == c and r["grade"] > i) for i in range(len(THRESHOLDS))]
        random = above[-1] / (1 - THRESHOLDS[-1])
        fits = [t for t, n in zip(THRESHOLDS, above) if n and max(0.0, n - random * (1 - t)) <= FALSE_SHARE * n]
        out.append(fits[0] if fits else 2.0)
    return out


def scan(docs: DataFrame, own: str = "spans") -> DataFrame:
    """docs(text, ...) with ``own``: (start, kind, end) in order, kinds numbered as KINDS; the base ones and those added."""
    least = F.array(*map(F.lit, thresholds(docs)))
    assign = F.filter(matches("text", ASSIGN), lambda x: F.length(F.regexp_extract(x["part"], ASSIGN, 2)) >= LEAST_ASSIGNED)
    random = F.filter(candidates("text"), lambda r: r["p"] >= F.get(least, r["class"]))
    empty = F.array().cast("array<struct<start int, kind int, end int>>")

    def of_kind(found: Column, kind: int) -> Column:
        return F.coalesce(F.transform(found, lambda x: F.struct(x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end"))), empty)

    added = len(KINDS) - 1

    def outside(spans: Column) -> Column:
        """Without random runs within a base span: those whose end a base span that begins no later reaches."""
        reached = before(F.transform(spans, lambda x: F.when(x["kind"] < added, x["end"]).otherwise(0)), F.lit(0), lambda x, y: F.greatest(x, y))
        kept = lambda r: F.filter(spans, lambda x, i: (x["kind"] < added) | (F.get(r, i) < x["end"]))
        return F.when(F.exists(spans, lambda x: x["kind"] == added), let(reached, kept)).otherwise(spans)

    found = F.sort_array(F.concat(of_kind(assign, 0), of_kind(matches("text", ACCESS), 1), of_kind(matches("text", HEX), 2), of_kind(random, added)))
    return docs.select(*(F.col(f"`{c}`") for c in without(docs.columns, own)), let(found, outside).alias(own))


def spelled(spans: Column) -> Column:
    """kind:start:end of spans, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _merged(spans: Column) -> Column:
    """(start, end) of spans in order, overlapping ones as one; ``spans`` has one or more."""

    def of(reached: Column) -> Column:
        opens = F.filter(F.sequence(F.lit(0), F.size(spans) - 1), lambda i: (i == 0) | (F.get(spans, i)["start"] >= F.get(reached, i)))
        last = F.array_max(F.transform(spans, lambda x: x["end"]))
        end = lambda o, k: F.coalesce(F.get(reached, F.get(o, k + 1)), last)
        return let(opens, lambda o: F.transform(o, lambda i, k: F.struct(F.get(spans, i)["start"].alias("start"), end(o, k).alias("end"))))

    return let(before(F.transform(spans, lambda x: x["end"]), F.lit(0), lambda x, y: F.greatest(x, y)), of)


def redact(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """The documents with every span replaced by ``mask``, overlapping ones by one; n_chars follows. Others stay as they are."""
    own, t = "__secret_spans", F.col("text")
    hit = F.size(own) > 0
    froms = lambda m: F.concat(F.array(F.lit(0)), F.transform(m, lambda x: x["end"]))
    tos = lambda m: F.concat(F.transform(m, lambda x: x["start"]), F.array(F.length(t)))
    parts = lambda m: F.zip_with(froms(m), tos(m), lambda a, b: F.substring(t, a + 1, b - a))
    masked = F.array_join(let(let(F.col(own), _merged), parts), mask)
    cut = scan(docs, own).withColumn("text", F.when(hit, masked).otherwise(t))
    length = lambda c: F.when(hit, F.length("text").cast(docs.schema[c].dataType)).otherwise(F.col(c)).alias(c)
    return cut.select(*(length(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns))
