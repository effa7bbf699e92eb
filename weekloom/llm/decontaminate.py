"""Benchmark decontamination: document words inside any occurrence of a benchmark window.

Method: prefix-filtered set join. A window is a set of word shingles in which all must be found, so
its necessary prefix is one shingle; shingles are ordered by how often they occur in the corpus and a
window joins by its rarest one. A joined pair is kept if the window fits between the document's ends at
that place, and counts only if its words equal the document's words there. DataFrame functions only.

The corpus is read once: inside each row a bitmap of the benchmark's shingles (fixed size) picks the
positions that can matter, which are stored with the words around them. All later joins are over those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekloom.functions.bitmap import BITS as BITMAP_BITS
from weekloom.functions.bitmap import bitmap_of, in_bitmap
from weekloom.llm.common import ascii_lower, stored, text_key

WINDOW, SHINGLE = 10, 3
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]++"


def words(text: Column) -> Column:
    """Lower-cased runs of letters, digits and everything beyond ASCII; null has none."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD, -1), "")


def _hash(array: Column, at: Column, k: int) -> Column:
    return F.xxhash64(*[F.get(array, at + j) for j in range(k)])


def windows(items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct (window_id, w, n, k) and their items: n words, shingles of k words, item ids as sorted distinct strings."""
    split = items.select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("ws")).filter(F.size("ws") > 0)
    start = F.explode(F.sequence(F.lit(0), F.greatest(F.size("ws") - window, F.lit(0))))
    cut = split.select("item", "ws", start.alias("i")).select("item", F.slice("ws", F.col("i") + 1, F.lit(window)).alias("w"))
    return (cut.groupBy("w").agg(F.collect_set("item").alias("items")).withColumn("window_id", F.xxhash64(F.array_join("w", " ")))
            .withColumn("n", F.size("w")).withColumn("k", F.least("n", F.lit(shingle))))


def window_shingles(wins: DataFrame, sizes: list[int]) -> DataFrame:
    """(w, n, at, h): every shingle of every window."""
    parts = [wins.filter(F.col("k") == k).select("w", "n", F.explode(F.sequence(F.lit(0), F.col("n") - k)).alias("at"))
             .withColumn("h", _hash(F.col("w"), F.col("at"), k)) for k in sizes]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _positions(ws: Column, k: int, bitmap: Column, bits: int, window: int) -> Column:
    """Array of struct(pos, h, left, ctx) of the positions whose shingle of k words may be the benchmark's."""
    reach = window - 1

    def context(p: Column) -> Column:
        left = F.least(p, F.lit(reach))
        return F.struct(p.alias("pos"), _hash(ws, p, k).alias("h"), left.alias("left"), F.slice(ws, p - left + 1, left + k + reach).alias("ctx"))

    at = F.when(F.size(ws) >= k, F.sequence(F.lit(0), F.size(ws) - k)).otherwise(F.expr("CAST(array() AS array<int>)"))
    return F.transform(F.filter(at, lambda p: in_bitmap(_hash(ws, p, k), bitmap, bits)), context)


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, bits: int = BITMAP_BITS, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: id, text_key, n_words, n_hit, item_list (sorted strings).

    A window is ``window`` consecutive words of an item; an item of fewer words, but not none, is one
    window. A document word inside any occurrence of a window is hit.

    Defined results: null or empty texts have no words and no hits; items without words have no
    window; items with equal windows all count; a null item id hits words but is not listed; repeated
    item ids count once; repeated documents each get their own row; an empty benchmark hits nothing.
    Other columns are not looked at.
    """
    wins = stored(windows(items, window, shingle, item_col, item_text_col), "windows")
    sizes = sorted(r.k for r in wins.select("k").distinct().collect())       # 1 to ``shingle``
    base = docs.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("text_key"), words(F.col(text_col)).alias("ws"))
    if not sizes:
        return base.select("id", "text_key", F.size("ws").cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"),
                           F.expr("CAST(array() AS array<string>)").alias("item_list"))
    shingles = stored(window_shingles(wins, sizes), "window-shingles")
    bitmap = bitmap_of(shingles, "h", bits)
    found = F.concat(*[_positions(F.col("ws"), k, bitmap, bits, window) for k in sizes])
    marked = stored(base.select("id", "text_key", F.size("ws").cast("long").alias("n_words"), found.alias("found")), "marked")

    places = marked.select("id", "text_key", "n_words", F.explode("found").alias("f")).select("id", "text_key", "n_words", "f.*")
    counts = places.groupBy("h").agg(F.count(F.lit(1)).alias("seen"))
    rarest = F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "h", "at")
    prefix = stored(shingles.join(counts, "h", "left").groupBy("w").agg(F.min(rarest).alias("r"), F.first("n").alias("n")).select("w", "n", "r.h", "r.at"), "prefix")

    start = F.col("pos") - F.col("at")
    fits = (start >= 0) & (start + F.col("n") <= F.col("n_words"))
    same = F.slice("ctx", F.col("left") - F.col("at") + 1, F.col("n")) == F.col("w")
    hits = stored(places.join(prefix, "h").filter(fits & same).select("id", "text_key", start.alias("start"), "n", F.xxhash64(F.array_join("w", " ")).alias("window_id")),
                  "hits")

    def cover(acc: Column, s: Column) -> Column:
        end = s["start"] + s["n"]
        return F.struct((acc["n"] + F.greatest(end - F.greatest(s["start"], acc["end"]), F.lit(0))).alias("n"), F.greatest(end, acc["end"]).alias("end"))
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    spans = hits.groupBy("id", "text_key").agg(F.sort_array(F.collect_set(F.struct("start", "n"))).alias("spans"))
    covered = spans.select("id", "text_key", F.aggregate("spans", zero, cover, lambda acc: acc["n"]).cast("long").alias("n_hit"))
    listed = (hits.select("id", "text_key", "window_id").distinct().join(wins.select("window_id", F.explode("items").alias("item")), "window_id")
              .groupBy("id", "text_key").agg(F.sort_array(F.collect_set("item")).alias("item_list")))
    verdict = covered.join(listed, covered["id"].eqNullSafe(listed["id"]) & (covered["text_key"] == listed["text_key"]), "left").select(
        covered["id"].alias("__id"), covered["text_key"].alias("__key"), "n_hit", "item_list")
    rows = marked.select("id", "text_key", "n_words")
    return (rows.join(verdict, rows["id"].eqNullSafe(F.col("__id")) & (rows["text_key"] == F.col("__key")), "left")
            .select("id", "text_key", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                    F.coalesce("item_list", F.expr("CAST(array() AS array<string>)")).alias("item_list")))
