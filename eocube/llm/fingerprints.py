"""Document fingerprints by consistent weighted sampling.

A document is the set of its words, weighted by how often they occur. For each sample, a
word of weight ``S`` draws ``r`` and ``c`` from Gamma(2, 1) and ``b`` uniformly, all from
hashes of the word and the sample's number. With ``t = floor(ln S / r + b)`` its value is
``ln c - r (t - b + 1)``, and the smallest value of all words is the sample. The value
depends on the word, the sample and ``t`` alone, so equal values stand for an equal pair of
word and ``t``, and two documents agree in a sample with a probability that equals their
generalised Jaccard similarity, sum of minima over sum of maxima of the weights.

Only DataFrame functions are used: words are exploded, counted and sampled in generated
code. One shuffle carries the texts, by ranges of ``doc_id``; counting and taking minima
follow its partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eocube.llm.tables import written

SAMPLES = 32
GROUP = 4
SLOT = 8
RANGES = 64
RANGE_ROWS = 20_000
LEAST_PARTS = 32
BLANKS = " \t\n\x0b\x0c\r"
SPACES = "[ \\t\\n\\x0B\\f\\r]+"


def words(text: Column) -> Column:
    """Words between ASCII white space; a text without any is one empty word."""
    return F.split(F.trim(text, F.lit(BLANKS)), SPACES, -1)


def _uniforms(h: Column) -> Column:
    """The product of two uniform numbers, from the halves of a 64-bit hash."""
    upper = F.shiftrightunsigned(h, 32) + 0.5
    lower = h.bitwiseAND(F.lit(0xFFFFFFFF).cast("bigint")) + 0.5
    return upper * lower * 2.0**-64


def sample_value(term: Column, log_weight: Column, sample: Column) -> Column:
    """The value of a word of a weight in a sample; the smallest of a document is kept."""
    one = F.xxhash64(term, sample)
    two = F.xxhash64(one)
    b = (F.shiftrightunsigned(F.xxhash64(two), 11) + 0.5) * 2.0**-53
    r = -F.ln(_uniforms(one))
    c = -F.ln(_uniforms(two))
    steps = F.when(log_weight == 0, 0.0).otherwise(F.floor(log_weight / r + b).cast("double"))
    return F.ln(c) - r * (steps - b + 1.0)


def sampled(terms: DataFrame, keys: list[str], prints: dict[str, str], samples: int = SAMPLES) -> DataFrame:
    """``(*keys, *prints)``: fingerprints, hexadecimal, eight digits a sample.

    ``prints`` names the weight column that each fingerprint follows; a word whose weight
    is 0 is not in it. A word is sampled once for all fingerprints in which it weighs the
    same. Samples are taken in groups of four: a row computes four of them, small enough
    for the compiler, and each group keeps its four minima per key.
    """
    weights = list(prints.values())
    each = F.array(*weights)
    if len(weights) == 2:
        each = F.when(F.col(weights[0]) == F.col(weights[1]), F.array(weights[0])).otherwise(each)
    groups = F.array(*(F.lit(g) for g in range(samples // GROUP)))
    rows = terms.select(*keys, "term", *weights, F.explode(each).alias("w")).where("w > 0")
    rows = rows.select(
        *keys, "term", *((F.col(w) == F.col("w")).alias(w) for w in weights), F.ln("w").alias("lw"), F.explode(groups).alias("g")
    )
    values = [sample_value(F.col("term"), F.col("lw"), F.col("g") * GROUP + j) for j in range(GROUP)]
    rows = rows.select(*keys, "g", *weights, *(v.alias(f"v{j}") for j, v in enumerate(values)))
    least = rows.groupBy(*keys, "g").agg(
        *(F.min(F.when(F.col(w), F.col(f"v{j}"))).alias(f"{w}_{j}") for w in weights for j in range(GROUP))
    )
    digits = lambda c: F.lpad(F.lower(F.hex(F.shiftrightunsigned(F.xxhash64(c), 32))), SLOT, "0")
    parts = least.select(
        *keys, F.struct("g", *(F.concat(*(digits(f"{w}_{j}") for j in range(GROUP))).alias(w) for w in weights)).alias("piece")
    )
    ordered = parts.groupBy(*keys).agg(F.array_sort(F.collect_list("piece")).alias("pieces"))
    return ordered.select(
        *keys, *(F.array_join(F.col(f"pieces.{w}"), "").alias(name) for name, w in prints.items())
    )


def likeness(one: Column, two: Column, samples: int = SAMPLES) -> Column:
    """The share of equal samples of two fingerprints."""
    slots = F.sequence(F.lit(0), F.lit(samples - 1))
    at = lambda c, i: F.substring(c, i * SLOT + 1, F.lit(SLOT))
    return F.size(F.filter(slots, lambda i: at(one, i) == at(two, i))) / samples


def _range_of(value: Column, bounds: list[int], low: int, high: int, parts: int) -> Column:
    """A number that grows with the value: its quantile range, cut into equal parts."""
    edges = [low, *bounds, high + 1]

    def search(a: int, z: int) -> Column:
        if z - a == 1:
            width = max(1, -(-(edges[z] - edges[a]) // parts))
            return F.lit(a * parts) + F.floor((value - F.lit(edges[a])) / width)
        middle = (a + z) // 2
        return F.when(value < edges[middle], search(a, middle)).otherwise(search(middle, z))

    return search(0, len(edges) - 1).cast("bigint")


def with_next(docs: DataFrame) -> DataFrame:
    """``(part, seq, doc_id, text, hash, next_text, next_hash)`` in descending ``doc_id``, the first after the last.

    The next row is found within ranges of ids; the first row of each range also visits the
    range before it. Ranges follow the quantiles of the ids. Equal ids follow one another by
    a hash of the text; rows without id come last, in ranges of that hash.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    steps = [i / RANGES for i in range(1, RANGES)]
    n, low, high, marks = rows.agg(
        F.count("*"), F.min("doc_id"), F.max("doc_id"), F.percentile_approx("doc_id", steps, 10_000)
    ).first()
    parts = max(LEAST_PARTS, -(-n // (RANGES * RANGE_ROWS)))
    blank = -1 - F.pmod(F.xxhash64("text"), F.lit(RANGES * parts))
    if low is None:
        place = blank
    else:
        bounds = sorted({m for m in marks if m > low})
        place = F.when(F.col("doc_id").isNull(), blank).otherwise(_range_of(F.col("doc_id"), bounds, low, high, parts))
    rows = rows.select(place.alias("part"), "doc_id", "text", F.xxhash64("text").alias("hash"))
    # rows of a range count down, so its first row has the largest id
    down = F.struct(F.bitwise_not("doc_id").alias("id"), "hash")
    heads = rows.groupBy("part").agg(F.min(down).alias("head"))
    every = Window.orderBy(F.col("part").desc())
    last = F.min("part").over(Window.partitionBy())
    visits = heads.select(
        F.col("part").alias("home"), F.coalesce(F.lag("part").over(every), last).alias("to"),
        F.bitwise_not("head.id").alias("head_id"), F.col("head.hash").alias("head_hash"),
    )
    visits = written(visits, "range-heads")
    if visits.count() <= 100_000:
        visits = F.broadcast(visits)
    guests = rows.join(
        visits,
        (rows["part"] == visits["home"]) & rows["doc_id"].eqNullSafe(visits["head_id"]) & (rows["hash"] == visits["head_hash"]),
    ).select(F.col("to").alias("part"), "doc_id", "text", "hash", F.lit(True).alias("guest"))
    order = Window.partitionBy("part").orderBy("guest", F.col("doc_id").desc_nulls_last(), "hash")
    near = rows.withColumn("guest", F.lit(False)).unionByName(guests)
    return near.select(
        "part", "doc_id", "text", "hash", "guest", F.lead("text").over(order).alias("next_text"),
        F.lead("hash").over(order).alias("next_hash"), F.row_number().over(order).alias("seq"),
    ).where(~F.col("guest")).drop("guest")


def edited(text: Column, following: Column) -> Column:
    """The text with its last half, rounded down, replaced by as much of the next one's start."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))


def fingerprints(docs: DataFrame, *, samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of every row of ``(doc_id, text)``, of its edited text, and their likeness.

    Columns: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``. A null text is empty; texts without words share one fingerprint; equal
    texts have equal fingerprints. Rows of one ``doc_id`` are each other's neighbours; a
    single row is its own next. Other columns are ignored, an empty table stays empty. A text
    of any length counts with all its words, which are grouped before they are sampled.
    """
    if samples % GROUP:
        raise ValueError(f"samples must be a multiple of {GROUP}")
    pairs = with_next(docs).withColumn("other", edited(F.col("text"), F.col("next_text")))
    described = pairs.select(
        "part", "seq", "doc_id", "hash", "next_hash", F.length("text").cast("bigint").alias("n_chars"),
        F.sha2(F.col("other").cast("binary"), 256).alias("edited_sha256"),
    )
    both = F.explode(F.array(F.struct(F.lit(0).alias("which"), "text"), F.struct(F.lit(1).alias("which"), F.col("other").alias("text"))))
    terms = pairs.select("part", "seq", both.alias("v")).select(
        "part", "seq", F.col("v.which").alias("which"), F.explode(words(F.col("v.text"))).alias("word")
    )
    counted = terms.select("part", "seq", "which", F.xxhash64("word").alias("term")).groupBy("part", "seq", "term").agg(
        F.sum(1 - F.col("which")).alias("own"), F.sum("which").alias("changed")
    )
    prints = sampled(counted, ["part", "seq"], {"fingerprint": "own", "edited_fingerprint": "changed"}, samples)
    table = written(described.join(prints, ["part", "seq"]), "fingerprints")
    known = table.groupBy(F.col("hash").alias("next_hash")).agg(F.first("fingerprint").alias("next_fingerprint"))
    return table.join(written(known, "known-fingerprints"), "next_hash").select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint"), samples).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint"), samples).alias("near_next"),
    )
