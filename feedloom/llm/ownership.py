"""Secrets in texts, and who owns them: only DataFrame functions, no Python on the rows.

Base patterns find assignments, access keys and long hexadecimal strings. The corpus adds what
one text cannot tell: every candidate value is hashed and counted over the distinct
repositories and owners that hold it. A value that few owners hold looks live; one that
many hold is a copied example. Opaque strings outside the base spans (long, with letters
and digits) become spans when they look live; base spans stay whatever their count.

Texts are read once: spans and value hashes are stored without the texts, and counts are
combined per value and owner before any value's rows meet, so a widely copied value is no
hot key. The join back is salted for the same reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import spare, stored

#: Fixed patterns, and the least length of what each must hold.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 6
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"
OPAQUE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+"
KINDS = ("assign", "access", "hex", "opaque")

#: Most owners of a value that looks live.
LIVE_OWNERS = 2
SALTS = 16

_SPAN = "struct<start:bigint,rank:int,end:bigint,hash:bigint,keep:boolean>"


def _found(text: Column, kind: int, pattern: str, group: int, keep) -> Column:
    """Spans (code points, end exclusive) of the matches that ``keep``, a test of the value, passes.

    The pieces between matches and the matches themselves give every position by addition.
    """
    zipped = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("v"), F.split(text, pattern, -1).alias("p"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.char_length(x["p"])
        end = start + F.char_length(x["m"])
        span = F.struct(start.alias("start"), F.lit(kind).alias("rank"), end.alias("end"), F.xxhash64(x["v"]).alias("hash"), F.lit(True).alias("keep"))
        spans = F.when(keep(x["v"]), F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.struct(F.coalesce(end, acc["at"]).alias("at"), spans.alias("spans"))

    empty = F.array().cast(f"array<{_SPAN}>")
    all_spans = F.aggregate(zipped, F.struct(F.lit(0).cast("bigint").alias("at"), empty.alias("spans")), step, lambda acc: acc["spans"])
    return F.when(text.rlike(pattern), all_spans).otherwise(empty)


def candidates(docs: DataFrame, repository: str = "source", owner: str = "source") -> DataFrame:
    """Per row of ``docs``: doc_id, a digest of the text, repository, owner, base spans and opaque spans outside them."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id"),
        F.col(repository).cast("string").alias("repository"),
        F.col(owner).cast("string").alias("owner"),
        F.sha2(text, 256).alias("digest"),
        _found(text, 0, ASSIGN, 2, lambda v: F.char_length(v) >= ASSIGN_LEAST).alias("a"),
        _found(text, 1, ACCESS, 0, lambda v: v.isNotNull()).alias("k"),
        _found(text, 2, HEX, 0, lambda v: v.isNotNull()).alias("h"),
        _found(text, 3, OPAQUE, 0, lambda v: v.rlike("[0-9]") & v.rlike("[A-Za-z]")).alias("o"),
    )
    rows = rows.withColumn("base", F.array_sort(F.concat("a", "k", "h")))
    outside = F.filter("o", lambda x: ~F.exists("base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))
    return rows.select("doc_id", "repository", "owner", "digest", F.size("a").alias("n_assign"), F.size("k").alias("n_access"), F.size("h").alias("n_hex"), "base", outside.alias("opaque"))


def value_owners(found: DataFrame) -> DataFrame:
    """Per candidate hash: distinct repositories, distinct owners, documents."""
    spans = found.select("doc_id", "digest", "repository", "owner", F.explode(F.concat("base", "opaque")).alias("s"))
    each = spans.groupBy(F.col("s.hash").alias("hash"), "repository", "owner").agg(F.count(F.lit(1)).alias("n"))
    by_owner = each.groupBy("hash", "owner").agg(F.sum("n").alias("n"))
    by_repository = each.groupBy("hash", "repository").agg(F.lit(1).alias("one"))
    null_too = F.max(F.when(F.col("owner").isNull(), 1).otherwise(0))
    owners = by_owner.groupBy("hash").agg((F.count("owner") + null_too).alias("n_owners"), F.sum("n").alias("n_spans"))
    repositories = by_repository.groupBy("hash").agg(F.count("one").alias("n_repositories"))
    return owners.join(repositories, "hash")


def scan(docs: DataFrame, repository: str = "source", owner: str = "source", live_owners: int = LIVE_OWNERS) -> DataFrame:
    """Per row of ``docs(doc_id, text, ...)`` its spans, and which of them look live.

    Columns: doc_id, digest, n_assign, n_access, n_hex, base (spans by start, then kind),
    added (opaque spans that look live), live (base or added spans whose value at most
    ``live_owners`` owners hold), most_owners (of any base value).

    NULL text counts as empty and has no spans. NULL owners and repositories count as one of
    their own. Every row is kept; rows equal in doc_id and text get equal results, and
    each counts once per owner. An empty table stays empty; other columns are not read.
    """
    found = stored(candidates(docs, repository, owner), "secret-spans")
    counts = value_owners(found).select(F.col("hash").alias("value"), "n_owners")
    salted = counts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    some = found.where(F.size("base") + F.size("opaque") > 0).select("doc_id", "digest", "base", "opaque").dropDuplicates(["doc_id", "digest"])
    spans = some.select("doc_id", "digest", F.explode(F.concat("base", "opaque")).alias("s")).withColumn("_salt", F.pmod(F.xxhash64("doc_id", "digest"), F.lit(SALTS)).cast("int"))
    held = spans.join(salted, (F.col("s.hash") == F.col("value")) & (F.col("_salt") == F.col("salt")))
    live = F.col("n_owners") <= live_owners
    opaque = F.col("s.rank") == 3
    judged = held.groupBy("doc_id", "digest").agg(
        F.array_sort(F.collect_list(F.when(live & opaque, F.col("s")))).alias("added"),
        F.array_sort(F.collect_list(F.when(live, F.col("s")))).alias("live"),
        F.max(F.when(~opaque, F.col("n_owners"))).alias("most_owners"),
    )
    judged = judged.select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), "added", "live", "most_owners")
    rows = found.join(judged, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")), "left")
    none = F.array().cast(f"array<{_SPAN}>")
    return rows.select("doc_id", "digest", "n_assign", "n_access", "n_hex", "base", F.coalesce("added", none).alias("added"), F.coalesce("live", none).alias("live"), "most_owners")


def spelled(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["rank"] + 1), s["start"], s["end"])), ",")


def digest_of(scanned: DataFrame) -> DataFrame:
    """The columns of the contract, from the spans."""
    return scanned.select(
        "doc_id",
        F.col("n_assign").cast("long").alias("n_assign"),
        F.col("n_access").cast("long").alias("n_access"),
        F.col("n_hex").cast("long").alias("n_hex"),
        F.sha2(spelled(F.col("base")), 256).alias("base_sha256"),
        spelled(F.array_sort(F.concat("base", "added"))).alias("spans"),
        F.size("live").cast("long").alias("n_live"),
        F.coalesce("most_owners", F.lit(0)).cast("long").alias("most_owners"),
    )


def redact(docs: DataFrame, mark: str = "[SECRET]", repository: str = "source", owner: str = "source", live_owners: int = LIVE_OWNERS) -> DataFrame:
    """``docs`` with every span that looks live replaced by ``mark``; copied examples stay.

    Overlapping spans become one mark. Rows and columns are those of ``docs``; NULL text
    stays NULL. ``n_chars``, where there is one, follows the text.
    """
    own_id, own_digest, live, clean_text = spare(docs, "own_id", "own_digest", "live", "clean_text")
    hidden = scan(docs, repository, owner, live_owners).where(F.size("live") > 0)
    hidden = hidden.select(F.col("doc_id").alias(own_id), F.col("digest").alias(own_digest), F.col("live").alias(live)).dropDuplicates([own_id, own_digest])
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.join(hidden, F.col("doc_id").eqNullSafe(F.col(own_id)) & (F.sha2(text, 256) == F.col(own_digest)), "left")

    def step(acc: Column, s: Column) -> Column:
        start, end = s["start"], s["end"]
        fresh = start >= acc["at"]
        out = F.when(fresh, F.concat(acc["out"], F.substring(text, acc["at"] + 1, start - acc["at"]), F.lit(mark))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], end).alias("at"), out.alias("out"))

    begin = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))
    clean = F.aggregate(live, begin, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.char_length(text))))
    rows = rows.withColumn(clean_text, F.when(F.col(live).isNull(), F.col("text")).otherwise(clean))
    out = []
    for name in docs.columns:
        column = F.col(f"`{name}`")
        if name == "text":
            column = F.col(clean_text)
        elif name == "n_chars":
            column = F.when(F.col(live).isNull(), column).otherwise(F.char_length(clean_text).cast(docs.schema["n_chars"].dataType))
        out.append(column.alias(name))
    return rows.select(*out)
