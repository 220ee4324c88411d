"""Order MinHash fingerprints: signatures that feel edits and re-ordering.

A text is cut into words (stretches of up to 16 characters between white
space).  Every run of K words is a k-mer; the j-th occurrence of an equal k-mer
is numbered j, so repeats count.  The numbered k-mers are hashed into SLOTS
slots; in each slot the L smallest hashes are selected, put back into their
order in the text, and hashed as one tuple.  The fingerprint is the list of
slot tuples; two fingerprints are as alike as the share of slots they agree
on, among those either one fills.

Everything is a column expression, evaluated per row without a shuffle: k-mers
are packed with their position into one long (39 bits of hash, 24 of position),
so sorting an array of longs groups equal k-mers and orders hashes.

Edge cases: null counts as the empty text; texts without words have the empty
fingerprint and are alike with likeness 1; positions wrap after 2**24 words.
In the query, repeated rows of an id are each fingerprinted (as somebody's
next document, the smallest text of the id counts), and a row with a null id
has no next document: its edited text is its first half and near_next is null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]{1,16}"
K = 2
L = 2
SLOT_BITS = 6
POS_BITS = 24
HASH_BITS = 63 - POS_BITS
REST_BITS = HASH_BITS - SLOT_BITS
TUPLE_BITS = 25             # of a slot's tuple hash; with the slot it fills an int
ID_BITS = 12                # ids that share all but these bits form one group


def _mask(bits: int) -> Column:
    return F.lit((1 << bits) - 1)


def _packed(hashed: Column, pos: Column) -> Column:
    top = F.shiftleft(F.shiftrightunsigned(hashed, 64 - HASH_BITS), POS_BITS)
    return top.bitwiseOR(pos.cast("long").bitwiseAND(_mask(POS_BITS)))


def _run_starts(values: Column, shift: int) -> Column:
    """Indices at which the bits above ``shift`` change in a sorted array."""
    def start(x, i):
        new = (i == 0) | (F.shiftright(x, shift) != F.shiftright(F.get(values, i - 1), shift))
        return F.when(new, i)
    return F.array_compact(F.transform(values, start))


def _steps(text: Column) -> list[tuple[str, object]]:
    """Named steps from a text to its fingerprint, each over the previous one."""
    def kmers(words: Column) -> Column:
        out = words
        for j in range(1, K):
            later = F.when(F.size(words) > j, F.slice(words, j + 1, F.size(words))).otherwise(F.array().cast("array<bigint>"))
            out = F.zip_with(out, later, lambda a, b: F.xxhash64(a, b))
        return out

    def again(packed: Column, x: Column, i: Column) -> Column:
        return (i > 0) & (F.shiftright(F.get(packed, i - 1), POS_BITS) == F.shiftright(x, POS_BITS))

    def numbered(packed: Column, repeats: Column, starts: Column) -> Column:
        first = F.transform(F.filter(packed, lambda x, i: ~again(packed, x, i)),
                            lambda x: _packed(F.xxhash64(F.shiftright(x, POS_BITS), F.lit(0)), x))

        def run(s, j):
            end = F.coalesce(F.get(starts, j + 1), F.size(repeats))
            return F.transform(F.slice(repeats, s + 1, end - s),
                               lambda x, o: _packed(F.xxhash64(F.shiftright(x, POS_BITS), o + 1), x))
        return F.sort_array(F.concat(first, F.flatten(F.transform(starts, run))))

    def selected(ranked: Column) -> Column:
        top = POS_BITS + REST_BITS
        kept = F.filter(ranked, lambda x, i: (i < L) | (F.shiftright(F.get(ranked, i - L), top) != F.shiftright(x, top)))
        return F.sort_array(F.transform(kept, lambda x: F.shiftleft(F.shiftright(x, top), top)
                                        .bitwiseOR(F.shiftleft(x.bitwiseAND(_mask(POS_BITS)), REST_BITS))
                                        .bitwiseOR(F.shiftright(x, POS_BITS).bitwiseAND(_mask(REST_BITS)))))

    def tuples(kept: Column, starts: Column) -> Column:
        def one(s, j):
            end = F.coalesce(F.get(starts, j + 1), F.size(kept))
            hashes = F.transform(F.slice(kept, s + 1, end - s), lambda x: x.bitwiseAND(_mask(REST_BITS)))
            slot = F.shiftright(F.get(kept, s), POS_BITS + REST_BITS)
            tuple_hash = F.shiftrightunsigned(F.xxhash64(hashes), 64 - TUPLE_BITS)
            return F.shiftleft(slot, TUPLE_BITS).bitwiseOR(tuple_hash).cast("int")
        return F.transform(starts, one)

    return [
        ("words", lambda c: F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w))),
        ("packed", lambda c: F.sort_array(F.transform(kmers(c("words")), lambda g, i: _packed(g, i)))),
        ("repeats", lambda c: F.filter(c("packed"), lambda x, i: again(c("packed"), x, i))),
        ("starts", lambda c: _run_starts(c("repeats"), POS_BITS)),
        ("ranked", lambda c: numbered(c("packed"), c("repeats"), c("starts"))),
        ("kept", lambda c: selected(c("ranked"))),
        ("slots", lambda c: _run_starts(c("kept"), POS_BITS + REST_BITS)),
        ("prints", lambda c: tuples(c("kept"), c("slots"))),
    ]


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``: the slot tuples (slot, then hash, in one int) of a text column."""
    columns = df.columns
    for name, step in _steps(F.col(text)):
        df = df.withColumn(f"__{out}_{name}", step(lambda n: F.col(f"__{out}_{n}")))
    return df.select(*columns, F.col(f"__{out}_prints").alias(out))


def likeness(a: Column, b: Column) -> Column:
    """Share of slots on which two fingerprints agree; 1 if both are empty."""
    slots = F.size(F.array_union(F.transform(a, lambda x: F.shiftright(x, TUPLE_BITS)),
                                 F.transform(b, lambda x: F.shiftright(x, TUPLE_BITS))))
    return F.when(slots == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / slots)


def as_text(prints: Column) -> Column:
    return F.concat_ws("", F.transform(prints, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")))


def successors(ids: DataFrame) -> DataFrame:
    """(id, next_id): the next larger id; after the largest comes the smallest.

    Ids are grouped by their leading bits; inside a group the next one is a
    window away, and the last of a group takes the first id of the group's
    successor, found by the same rule one level up.  No task sees more than
    2**ID_BITS ids.
    """
    ids = ids.filter(F.col("id").isNotNull()).distinct()
    ends = ids.agg(F.min("id").alias("lo"), F.max("id").alias("hi")).first()
    if ends["lo"] is None:
        return ids.select("id", F.col("id").alias("next_id"))
    return _linked(ids, ends["lo"], ends["hi"]).select(
        "id", F.coalesce("next_id", F.lit(ends["lo"])).alias("next_id"))


def _linked(ids: DataFrame, lo: int, hi: int, signed: bool = True) -> DataFrame:
    flip = -(1 << 63) if signed else 0          # so that negative ids come first, and none is below 0
    group = F.shiftrightunsigned(F.col("id").bitwiseXOR(F.lit(flip)), ID_BITS)
    inside = ids.select(group.alias("g"), "id").withColumn(
        "inner", F.lead("id").over(Window.partitionBy("g").orderBy("id")))
    lo, hi = (lo - flip) >> ID_BITS, (hi - flip) >> ID_BITS
    if lo == hi:
        return inside.select("id", F.col("inner").alias("next_id"))
    first = ids.groupBy(group.alias("id")).agg(F.min("id").alias("first"))
    after = _linked(first.select("id"), lo, hi, signed=False).alias("a").join(
        first.alias("f"), F.col("a.next_id") == F.col("f.id")).select(F.col("a.id").alias("g"), "first")
    return inside.join(after, "g", "left").select("id", F.coalesce("inner", "first").alias("next_id"))


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, the fingerprint of the next document, and ``edited``: the
    text whose last half is replaced by the beginning of the next document.

    The texts are shuffled once, by doc_id: both joins read that exchange.
    """
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    placed = base.filter(F.col("doc_id").isNotNull())
    half = placed.groupBy("doc_id").agg(F.max(F.floor(F.char_length("text") / 2)).alias("half"))
    wanted = (successors(placed.select(F.col("doc_id").cast("long").alias("id")))
              .join(half.withColumnRenamed("doc_id", "id"), "id")
              .select(F.col("next_id").alias("doc_id"), F.col("id").alias("to"), "half"))
    heads = (with_fingerprint(placed.join(wanted, "doc_id"), "text", "next_own")
             .select(F.col("to").alias("doc_id"),
                     F.struct(F.substring(F.col("text"), F.lit(1), F.col("half").cast("int")).alias("head"),
                              "next_own").alias("n"))
             .groupBy("doc_id").agg(F.min("n").alias("n")))
    chars = F.char_length("text")
    taken = F.floor(chars / 2).cast("int")
    kept = F.substring(F.col("text"), F.lit(1), chars - taken)
    # rows of one id may differ in length: no more of the head than this row's half
    edited = F.concat(kept, F.substring(F.col("n.head"), F.lit(1), taken))
    joined = placed.join(heads, "doc_id", "left").select("doc_id", "text", edited.alias("edited"), "n.next_own")
    unplaced = base.filter(F.col("doc_id").isNull()).select(
        "doc_id", "text", kept.alias("edited"), F.lit(None).cast("array<int>").alias("next_own"))
    return joined.unionByName(unplaced)


def op2_order_minhash(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited form, and their likeness."""
    prints = with_fingerprint(with_fingerprint(with_next(docs), "text", "own"), "edited", "changed")
    return prints.select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("own")).alias("fingerprint"), as_text(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("next_own")).alias("near_next"))
