"""Secret scan that links the parts of a credential; DataFrame functions only.

Strong spans (assigned secrets, access identifiers, long hex runs) stand on their own. Weak parts - user names,
short-key secrets, bare key-like words, endpoints - are far too common to report alone: one is reported only when
a complementary part (a secret beside an identifier or endpoint, or the other way round) lies in the same scope,
``SCOPE`` code points around it. Parts are joined as intervals: each is dealt to the cells of the text that its
scope touches, and the join is on text digest and cell, so a cell holds a few parts whatever the text's length.

Positions come from the lengths of a pattern's matches and of the pieces between them, in the row. Only texts with
weak parts are shuffled, as digests and numbers, copies of a text once.

Null texts count as empty, equal rows give equal spans, ids and other columns may hold anything. `with_secrets` replaces
columns named ``secrets`` and ``strong_secrets``; no other name clashes. Places and masked texts are put together in
chunks of about the root of the number of spans: 20,000 spans in one text took 5 s to find and 4 s to mask. An empty
table gives none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kanaat.llm.batches import set_aside
from kanaat.llm.registry import query, table
from kanaat.llm.storage import stored

SCOPE = 160
# Fixed patterns of the strong kinds; an assigned value counts from 6 characters on.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
LEAST_VALUE = 6
# Weak parts: what a name before it makes an identifier or a secret, what only looks like a key, where it may be used.
LOGIN = r"""(?i)\b(?:user(?:_?name)?|login|account|client_?id|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@+-]{3,}"""
KEY = (r"""(?i)\b(?:pwd|pass(?:phrase)?|credentials?|private_?key|access_?key_?value|auth|bearer)["']?\x20*[:=]\x20*["']?"""
       r"""[A-Za-z0-9+/_.=-]{6,}""")
BARE = r"(?<![A-Za-z0-9+/=])(?=[A-Za-z+/]{0,39}[0-9])(?=[a-z0-9+/]{0,39}[A-Z])(?=[A-Z0-9+/]{0,39}[a-z])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])"
ENDPOINT = (r"""\b(?:https?|ftps?|ssh|jdbc:[a-z]+|mongodb|postgres(?:ql)?|mysql|redis|amqps?)://[^\s"'<>]+"""
            r"""|(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?::[0-9]{1,5})?(?![0-9.])""")

# (kind, pattern, role); the place in the list orders spans with the same start.
STRONG = [("assign", ASSIGN, "secret"), ("access", ACCESS, "identifier"), ("hex", HEX, "secret")]
WEAK = [("login", LOGIN, "identifier"), ("key", KEY, "secret"), ("bare", BARE, "secret"), ("endpoint", ENDPOINT, "endpoint")]
KINDS = [kind for kind, _, _ in STRONG + WEAK]
ROLE = {kind: role for kind, _, role in STRONG + WEAK}
SPANS = "array<struct<start:int,ord:int,end:int>>"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def folded(items: Column, out: str, step: Callable[[Column, Column], Column]) -> Column:
    """``at`` and ``out`` after all items, from 0 and nothing. Each step may append to ``out``; it does so to the list of
    its chunk, and only whole chunks to the list of all."""
    none = F.array().cast(out)

    def over(all_: Column) -> Column:
        each = F.ceil(F.sqrt(F.size(all_))).cast("int")

        def chunk(done: Column, i: Column) -> Column:
            here = F.aggregate(F.slice(all_, i * each + 1, each), F.struct(done["at"].alias("at"), none.alias("out")), step)
            return bound(here, lambda x: F.struct(x["at"].alias("at"), F.concat(done["out"], x["out"]).alias("out")))

        start = F.struct(F.lit(0).alias("at"), none.alias("out"))
        last = F.ceil(F.size(all_) / each).cast("int") - 1
        return F.when(F.size(all_) == 0, start).otherwise(F.aggregate(F.sequence(F.lit(0), last), start, chunk))

    return bound(items, over)


def spans(text: Column, kind: str, pattern: str, least_value: int = 0) -> Column:
    """Leftmost non-overlapping matches with their places in code points. ``least_value`` drops matches whose second
    group is shorter, after matching."""
    none = F.array().cast(SPANS)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if least_value else found
    gaps = F.slice(F.split(text, pattern, -1), 1, F.size(found))
    steps = F.arrays_zip(F.transform(gaps, F.length).alias("gap"), F.transform(found, F.length).alias("len"),
                         F.transform(value, F.length).alias("value"))

    def step(done: Column, x: Column) -> Column:
        start = done["at"] + x["gap"]
        span = F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("ord"), (start + x["len"]).alias("end"))
        more = F.concat(done["out"], F.array(span))
        return F.struct((start + x["len"]).alias("at"), F.when(x["value"] >= least_value, more).otherwise(done["out"]).alias("out"))

    return F.when(text.rlike(pattern), folded(steps, SPANS, step)["out"]).otherwise(none)


def with_parts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds ``_key`` (digest of the text), ``_strong`` and ``_weak`` (arrays of spans)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    strong = [spans(text, kind, pattern, LEAST_VALUE if kind == "assign" else 0) for kind, pattern, _ in STRONG]
    weak = [spans(text, kind, pattern) for kind, pattern, _ in WEAK]
    return docs.withColumns({"_key": F.md5(text), "_strong": F.array_sort(F.concat(*strong)), "_weak": F.concat(*weak)})


def linked(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """``_key`` and ``_linked``: the weak spans of each text that have a complementary part in their scope, each
    with the nearest such part. ``parts`` holds ``_key``, ``_strong`` and ``_weak``."""
    role = F.element_at(F.array(*[F.lit(ROLE[k]) for k in KINDS]), F.col("ord") + 1)

    def exploded(spans_: Column) -> DataFrame:
        return (parts.where(F.size("_weak") > 0).select("_key", F.explode(spans_).alias("s"))
                .select("_key", "s.start", "s.ord", "s.end").distinct().withColumn("role", role))

    def celled(df: DataFrame, around: int) -> DataFrame:
        low, high = F.greatest(F.col("start") - around, F.lit(0)), F.col("end") + around
        return df.withColumn("cell", F.explode(F.sequence((low / scope).cast("int"), (high / scope).cast("int"))))

    weak = celled(exploded(F.col("_weak")), scope).alias("w")
    other = celled(exploded(F.concat("_strong", "_weak")), 0).alias("o")
    complementary = (F.col("w.role") == "secret") != (F.col("o.role") == "secret")
    apart = F.greatest(F.col("o.start") - F.col("w.end"), F.col("w.start") - F.col("o.end"))
    pairs = weak.join(other, (F.col("w._key") == F.col("o._key")) & (F.col("w.cell") == F.col("o.cell"))
                      & complementary & (apart >= 0) & (apart <= scope))
    nearest = pairs.groupBy(*[F.col(f"w.{c}") for c in ("_key", "start", "ord", "end")]).agg(
        F.min(F.struct(apart.alias("apart"), F.col("o.start").alias("with_start"), F.col("o.ord").alias("with_ord"),
                       F.col("o.end").alias("with_end"))).alias("with"))
    return nearest.groupBy("_key").agg(F.array_sort(F.collect_list(
        F.struct("start", "ord", "end", F.col("with.with_start"), F.col("with.with_ord"), F.col("with.with_end"))
    )).alias("_linked"))


def named(parts: DataFrame, every: Column, keep: list[str]) -> DataFrame:
    """``keep`` and, as (start, end, kind) by start and kind, ``strong_secrets`` and ``secrets``."""
    names = F.array(*map(F.lit, KINDS))
    with_kind = lambda c: F.transform(c, lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), F.element_at(names, x["ord"] + 1).alias("kind")))
    return parts.select(*keep, with_kind(F.col("_strong")).alias("strong_secrets"), with_kind(every).alias("secrets"))


def attached(parts: DataFrame, links: DataFrame, keep: list[str]) -> DataFrame:
    weak = F.transform("_linked", lambda x: F.struct(x["start"], x["ord"], x["end"]))
    every = F.array_sort(F.concat("_strong", F.coalesce(weak, F.array().cast(SPANS))))
    return named(parts.join(links, "_key", "left"), every, keep)


def with_secrets(docs: DataFrame, text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """The rows of ``docs`` with ``secrets``: an array of (start, end, kind), strong ones and weak ones that are
    linked, ordered by start and kind; ``strong_secrets`` has the strong ones. Texts are searched once, rows without
    weak parts pass without a shuffle."""
    new = ["strong_secrets", "secrets"]
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in new])
    rows, _ = set_aside(docs, [text_col])
    found = stored(with_parts(rows, text_col), "secret-rows")
    links = linked(found.select("_key", "_strong", "_weak"), scope)
    plain = named(found.where(F.size("_weak") == 0), F.col("_strong"), rows.columns)
    every = plain.unionByName(attached(found.where(F.size("_weak") > 0), links, rows.columns))
    return every.toDF(*docs.columns, *new)


def listed(found: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def masked(text: Column, found: Column, mask: str = "<secret>") -> Column:
    """The text with every span, overlapping ones as one, replaced by ``mask``."""
    def step(done: Column, x: Column) -> Column:
        gap = F.array(F.struct(done["at"].alias("start"), x["start"].alias("end")))
        return F.struct(F.greatest(done["at"], x["end"]).alias("at"), F.when(x["start"] >= done["at"], F.concat(done["out"], gap)).otherwise(done["out"]).alias("out"))

    # A place in a text is found by counting from its begin, so gaps are cut from blocks of it, few of them across blocks.
    def cut(done: Column) -> Column:
        length = F.length(text)
        gaps = F.concat(done["out"], F.array(F.struct(done["at"].alias("start"), length.alias("end"))))
        block = F.greatest(F.lit(1024), F.ceil(length * F.sqrt(2 / F.size(gaps))).cast("int"))
        return F.struct(gaps.alias("gaps"), block.alias("block"), F.transform(
            F.sequence(F.lit(0), (length / block).cast("int")), lambda i: F.substr(text, i * block + 1, block)).alias("blocks"))

    def pieces(x: Column) -> Column:
        def piece(gap: Column) -> Column:
            long = gap["end"] - gap["start"]
            k = (gap["start"] / x["block"]).cast("int")
            inside = F.substr(F.get(x["blocks"], k), gap["start"] - k * x["block"] + 1, long)
            return F.when(gap["end"] <= (k + 1) * x["block"], inside).otherwise(F.substr(text, gap["start"] + 1, long))

        return F.array_join(F.transform(x["gaps"], piece), mask)

    hidden = bound(bound(folded(found, "array<struct<start:int,end:int>>", step), cut), pieces)
    return F.when(F.size(found) == 0, text).otherwise(hidden)


@query("op5_linked_secrets")
def op5_linked_secrets(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    parts = stored(with_parts(docs).drop("text"), "secret-parts")  # spans only, texts are read once
    found = attached(parts, linked(parts), ["doc_id"])
    count = lambda kind: F.size(F.filter("strong_secrets", lambda x: x["kind"] == kind)).cast("long")
    return found.select("doc_id", *[count(kind).alias(f"n_{kind}") for kind, _, _ in STRONG],
                        F.sha2(listed(F.col("strong_secrets")), 256).alias("base_sha256"),
                        listed(F.col("secrets")).alias("spans"))
