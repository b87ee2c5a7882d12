"""Quality rules as a bitmask ledger (DataFrame functions only).

Every rule is evaluated once for each document: the ledger holds the
measurements and one long whose bit i says that rule i failed. Policies are
versioned sets of bits; applying one, or comparing many, is bit arithmetic on
the ledger and never looks at a text again.

Defined cases: a null or empty text has no words, so all measurements are 0;
a null id stays null; repeated rows are judged one by one; extra columns of
the input are untouched (:func:`filter_documents`) or left out (:func:`ledger`).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words are runs of anything but space and U+0009 to U+000D.
WORD = "[^\\x20\\x09-\\x0D]+"
SYMBOLS = "[^#*$%&|<>]+"


@dataclass(frozen=True)
class Rule:
    """``fails`` is an expression over the measurements that is true for a failing document."""

    name: str
    fails: str


#: Position in the tuple is the bit number: append only, never reorder.
RULES: tuple[Rule, ...] = (
    Rule("too_few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "10 * n_symbols > 3 * n_words"),
    Rule("duplicate_lines", "10 * n_dup_lines > 8 * n_lines"),
    Rule("word_length", "n_words > 0 and (word_chars < 2 * n_words or word_chars > 15 * n_words)"),
    Rule("capitals", "10 * n_capitals > 3 * word_chars"),
    Rule("no_words", "n_words = 0"),
)

BIT = {r.name: i for i, r in enumerate(RULES)}

#: Versioned policies: the rules that reject a document.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("too_few_words", "repeated_words"),
    "v1": ("too_few_words", "repeated_words", "symbols", "word_length", "no_words"),
    "v2": ("too_few_words", "repeated_words", "symbols", "duplicate_lines", "word_length", "capitals", "no_words"),
}
CURRENT = "v2"


def mask_of(policy: str) -> int:
    return sum(1 << BIT[name] for name in POLICIES[policy])


def measurements(text: Column) -> dict[str, Column]:
    """The measured columns, as expressions over one text column.

    ``n_repeat_words`` needs no explode: windows are hashed to longs, sorted
    with their positions, those equal to a neighbour give the repeated start
    positions, and three words from each start, overlaps once, are the sum of
    min(3, distance to the next start).
    """
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    return {"_text": text, "_words": words}


def _measure(df: DataFrame, text_col: str) -> DataFrame:
    """Add ``_m`` with all measurements; helper columns live in structs only."""
    m = measurements(F.col(f"`{text_col}`"))
    df = df.withColumn("_w", m["_words"])
    hashes = F.transform("_w", lambda w: F.xxhash64(w))
    df = df.withColumn("_h", hashes)
    n = F.size("_w")
    df = df.withColumn("_k", F.when(n >= 3, F.transform(
        F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get("_h", i), F.get("_h", i + 1), F.get("_h", i + 2)))))
    # Most texts repeat no window: they need no sort.
    df = df.withColumn("_s", F.when(
        F.size(F.array_distinct("_k")) < F.size("_k"),
        F.sort_array(F.transform("_k", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    ))
    same = lambda i, j: F.get("_s", i)["h"] == F.get("_s", j)["h"]
    starts = F.sort_array(F.transform(
        F.filter("_s", lambda x, i: F.coalesce(same(i, i - 1), F.lit(False)) | F.coalesce(same(i, i + 1), F.lit(False))),
        lambda x: x["i"],
    ))
    df = df.withColumn("_p", starts)
    covered = F.aggregate(
        "_p",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")),
        lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last")),
        lambda a: a["n"],
    )
    lines = F.filter(F.split(m["_text"], "\n", -1), lambda x: F.regexp_like(x, F.lit(WORD)))
    df = df.withColumn("_l", lines)
    return df.withColumn("_m", F.struct(
        n.cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(m["_text"], SYMBOLS, "")).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("_l").cast("long").alias("n_lines"),
        F.length(F.regexp_replace(m["_text"], "[^A-Z]+", "")).cast("long").alias("n_capitals"),
    ))


def _bits(prefix: str = "") -> Column:
    """One long with every rule's failure bit."""
    expr = " + ".join(f"if({r.fails}, {1 << i}L, 0L)" for i, r in enumerate(RULES))
    return F.expr(expr)


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, measurements, ``failed_bits``."""
    d = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("_t"))
    return _measure(d, "_t").select("doc_id", "_m.*").withColumn("failed_bits", _bits())


def apply_policy(led: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Add ``base_failed`` and ``kept`` by a policy's mask; nothing is measured again."""
    return led.withColumns({
        "base_failed": F.col("failed_bits").bitwiseAND(F.lit(mask_of("base"))) != 0,
        "kept": F.col("failed_bits").bitwiseAND(F.lit(mask_of(policy) | mask_of("base"))) == 0,
    })


def ablations(led: DataFrame, policy: str = CURRENT) -> DataFrame:
    """For each rule of a policy: documents it fails, documents that only it
    rejects (kept again without it), and kept documents of the whole policy.
    One aggregation over the bits."""
    mask = mask_of(policy)
    rows = []
    aggs = [F.count("*").alias("n"), F.count_if(F.col("failed_bits").bitwiseAND(F.lit(mask)) == 0).alias("kept")]
    for name in POLICIES[policy]:
        bit = 1 << BIT[name]
        hit = F.col("failed_bits").bitwiseAND(F.lit(mask))
        aggs += [F.count_if(hit.bitwiseAND(F.lit(bit)) != 0).alias(f"f_{name}"), F.count_if(hit == bit).alias(f"o_{name}")]
        rows.append(F.struct(F.lit(name).alias("rule"), F.col(f"f_{name}").alias("n_failed"), F.col(f"o_{name}").alias("n_only")))
    return led.agg(*aggs).select(F.explode(F.array(*rows)).alias("r"), "n", "kept").select("r.*", F.col("n").alias("n_documents"), F.col("kept").alias("n_kept"))


def filter_documents(docs: DataFrame, text_col: str = "text", policy: str = CURRENT) -> DataFrame:
    """The documents a policy keeps, with exactly the input's columns."""
    d = docs.select(F.struct("*").alias("_row"), F.col(f"`{text_col}`").alias("_t"))
    judged = apply_policy(_measure(d, "_t").select("_row", "_m.*").withColumn("failed_bits", _bits()), policy)
    # A filter moves below deterministic projections and takes a copy of their
    # expressions along for each use. The row number in its condition keeps it
    # above the ledger, where every measurement is made once.
    return judged.select("_row", "kept", F.monotonically_increasing_id().alias("_n")).filter("kept and _n >= 0").select("_row.*")
