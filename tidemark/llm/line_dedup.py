"""Line dedup, built from DataFrame functions only.

Lines are exploded with a normalised key, hashed, and the documents of each
hash are counted; lines of keys over the threshold are dropped everywhere but
in the document with the largest id, and the rest is reassembled by position.

Skew: keys are made distinct inside a document before the explode, so a line
that a third of all documents hold is one row a document, combined map-side.
The join back to the positions is a plain shuffle join, which AQE splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, ascii_lower, hash128, staged


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``docs(doc_id, text, ...)`` -> ``docs`` with ``text`` cleaned, plus
    ``n_lines`` and ``n_dropped``.

    A text is split at ``\\n``; a line's key is the line without ASCII white
    space at both ends, A-Z lower-cased.  Keys of at least ``min_chars`` code
    points found in at least ``min_docs`` documents lose all their lines except
    in the document with the largest ``doc_id`` among those holding it.

    Null and empty texts have one empty line and become or stay empty.  Rows with
    the same id are one document, and so are all rows without one: they count
    once for a key, and each of them is returned.  Among rows that share the
    largest id all keep the line; a null id is below all others.  Extra columns
    pass through; columns already called ``n_lines`` or ``n_dropped`` are replaced.
    """
    order = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    extra = [c for c in order if c not in ("doc_id", "text")]
    text = F.coalesce(F.col("text"), F.lit(""))
    t1, t2 = hash128(text)
    ids = docs.select("doc_id", t1.alias("__t1"), t2.alias("__t2"),
                      F.split(ascii_lower(text), "\n").alias("__lines"))

    def entry(key, pos):
        a, b = hash128(key)
        return F.when(F.char_length(key) >= min_chars,
                      F.struct(a.alias("a"), b.alias("b"), pos.alias("pos")))

    keys = F.transform("__lines", lambda line: F.btrim(line, F.lit(SPACE)))
    entries = F.filter(F.transform(keys, entry), lambda e: e.isNotNull())
    lines = staged(ids.select("doc_id", "__t1", "__t2", entries.alias("__e"))
                   .where(F.array_size("__e") > 0), "lines")

    # Keys of ids that stand in one row are counted as they are; only those of
    # repeated ids have to be made distinct over rows first.
    repeated = staged(lines.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                      .select(F.col("doc_id").alias("id"), F.lit(True).alias("again")), "repeated")
    held = lines.join(repeated, F.col("doc_id").eqNullSafe(F.col("id")), "left").select(
        "doc_id", "again", F.array_distinct(F.transform(
            "__e", lambda e: F.struct(e["a"].alias("a"), e["b"].alias("b")))).alias("__k"))
    once = held.where("again is null").select("doc_id", F.inline("__k"))
    again = held.where("again").select("doc_id", F.inline("__k")).distinct()
    # Written, so that the join below shuffles both sides and AQE can split hot keys.
    common = staged(once.unionByName(again)
                    .groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keep"))
                    .where(F.col("n") >= min_docs).select("a", "b", "keep"), "common")
    drops = (lines.select("doc_id", "__t1", "__t2", F.inline("__e"))
             .join(common, ["a", "b"])
             .where(~F.col("doc_id").eqNullSafe(F.col("keep")))
             .groupBy("doc_id", "__t1", "__t2").agg(F.collect_set("pos").alias("__drop")))

    w = docs.select("doc_id", *[F.col(f"`{c}`") for c in extra], F.split(text, "\n").alias("__lines"),
                    t1.alias("__t1"), t2.alias("__t2")).alias("w")
    d = drops.alias("d")
    joined = w.join(d, F.col("w.doc_id").eqNullSafe(F.col("d.doc_id"))
                    & (F.col("w.__t1") == F.col("d.__t1")) & (F.col("w.__t2") == F.col("d.__t2")),
                    "left").select("w.doc_id", *[F.col(f"w.`{c}`") for c in extra],
                                   "w.__lines", "d.__drop")
    n = F.array_size("__lines")
    kept = F.array_except(F.sequence(F.lit(0), n - 1), "__drop")
    rebuilt = F.when(F.col("__drop").isNull(), F.array_join("__lines", "\n")).otherwise(
        F.array_join(F.transform(kept, lambda p: F.get("__lines", p)), "\n"))
    out = joined.withColumns({
        "text": rebuilt, "n_lines": n.cast("long"),
        "n_dropped": F.coalesce(F.array_size("__drop"), F.lit(0)).cast("long")})
    return out.select(*[F.col(f"`{c}`") for c in order], "n_lines", "n_dropped")
