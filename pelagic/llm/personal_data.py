"""Personal data by bootstrapped contextual extraction (DataFrame functions only).

Seeds are the matches of four base patterns. The words around seeds are lexical patterns; around candidates, which look
like identifiers but match no base pattern, the same ones are sought. Over the graph of patterns and instances, scores
go back and forth: a pattern is as sure as the share of its instances that are of one kind, an instance as sure as its
patterns make it. Instances that become sure enough are identifiers that no base pattern knows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, set_aside

KINDS = ("email", "ip", "card", "phone")
#: The base patterns, linear in Java: runs are possessive, and an attempt starts only where a run can start. The lookahead
#: of cards leaves out runs of fewer than 14 digits, which fail later anyway, as does any later start in such a run.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?=(?:[0-9][\x20-]?){13}[0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for the pattern to be worth a pass.
HINT = {"email": "@", "phone": "+"}
_TOKEN, _HEX = r"[^\s\"'<>,;=|]", "[0-9A-Fa-f]"
#: Tokens with an @, (at) or [at], tokens of four to eight groups of hex digits, and tokens, with the groups of digits after
#: them, that hold seven digits near each other. Groups of digits and dots alone may be of either of the last kinds.
_AT = r"[^\s\"'<>,;=|@]*+@|[^\s\"'<>,;=|(\[]*+(?:(?!(?i:\(at\)|\[at\]))[(\[][^\s\"'<>,;=|(\[]*+)*+" + rf"(?<={_TOKEN})(?i:\(at\)|\[at\]){_TOKEN}"
_GROUPS = rf"{_HEX}{{1,4}}(?:[.:]{_HEX}{{0,4}}){{2,6}}(?:[.:]{_HEX}{{1,4}}[.:!?)]*+|(?<=[^:]:):[.!?)]*+)(?!{_TOKEN})"
_DIGITS = r"[^0-9\s]{0,3}(?:[0-9][^0-9\n]{0,3}){6}[0-9]"
CANDIDATE = rf"(?<!{_TOKEN})(?:(?={_AT}|(?=[0-9.]*+[A-Fa-f:]){_GROUPS}){_TOKEN}++|(?={_DIGITS}){_TOKEN}++(?:\x20[0-9()./-]++)*+|(?={_GROUPS}){_TOKEN}++)"
#: What a text must hold for candidates to be worth a pass.
CANDIDATE_HINT = rf"@|(?i:\(at\)|\[at\])|[0-9][^0-9\n]{{0,3}}[0-9]|{_HEX}(?:[.:]{_HEX}{{0,4}}){{2}}[.:]"
#: Shapes in which an unseen identifier of a kind may come.
SHAPES = {
    "email": r"^[^@\s]+(@|\(at\)|\[at\])[^@\s]+$",
    "ip": r"^[0-9A-Fa-f]{1,4}([.:][0-9A-Fa-f]{0,4}){3,7}$",
    "card": r"^([0-9][ ./-]?){11,18}[0-9]$",
    "phone": r"^\+?\(?([0-9][ ()./-]{0,3}){6,14}[0-9]$",
}
MARK = "\u0001"
#: Characters of context on either side.
CONTEXT = 48
ROUNDS = 3
#: Sizes that keep the work on a text linear in its matches: pieces of arrays, blocks of spans, strips of text.
PIECE, BLOCK, STRIP = 256, 64, 4096
#: Up to so many sure patterns (some 100 bytes each) are broadcast, so that a very common one is no hot key.
BROADCAST_PATTERNS = 50_000
#: A pattern needs so many different seeds, and such a share of its instances; an instance such a score.
MIN_SEEDS, MIN_SHARE, MIN_SCORE = 5, 0.8, 0.9


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, however often body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _blocks(values: Column, size: int) -> Column:
    """An array in pieces of at most `size`; none for an empty one."""
    numbers = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / size).cast("int"))
    return F.transform(F.filter(numbers, lambda b: (b >= 0) & (b * size < F.size(values))), lambda b: F.slice(values, b * size + 1, size))


def _running(values: Column, op: Callable[[Column, Column], Column]) -> Column:
    """What op, an associative one, makes of 0 and the values before each, and of all: an array longer by one.

    An array grows by copies, so that long ones are put together from pieces.
    """

    def grown(some: Column, first: Column) -> Column:
        return F.aggregate(some, F.array(first), lambda out, x: F.concat(out, F.array(op(F.element_at(out, -1), x))))

    def pieced(pieces: Column) -> Column:
        ends = F.transform(pieces, lambda some: F.aggregate(some, F.lit(0), op))
        return _let(grown(ends, F.lit(0)), lambda begins: F.concat(
            F.flatten(F.transform(pieces, lambda some, k: F.slice(grown(some, begins[k]), 1, F.size(some)))), F.array(F.element_at(begins, -1)),
        ))

    return F.when(F.size(values) <= PIECE, grown(values, F.lit(0))).otherwise(_let(_blocks(values, PIECE), pieced))


def _sum(a: Column, b: Column) -> Column:
    return a + b


def _largest(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def _matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as (start, end, value): marked, split apart, and the lengths of the parts added up."""
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def placed(parts: Column, at: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(parts) - 1, F.lit(2)), lambda i: F.struct(at[i].alias("start"), at[i + 1].alias("end"), parts[i].alias("value")))

    def found(parts: Column) -> Column:
        lengths = F.transform(parts, lambda p: F.length(p))
        return F.when(F.size(parts) > 1, _let(lengths, lambda n: _let(_running(n, _sum), lambda at: placed(parts, at)))).otherwise(none)

    return _let(F.split(F.regexp_replace(text, pattern, f"{MARK}$0{MARK}"), MARK), found)


def _cut_up(text: Column) -> Column:
    """The text in strips of STRIP characters: a place in a strip is found without reading what comes before it."""
    return F.when(F.length(text) <= STRIP, F.array(text)).otherwise(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{STRIP}}}"), F.lit(0)))


def _between(strips: Column, start: Column, end: Column) -> Column:
    """The characters from start to end of a text in strips."""
    first, last = F.floor(start / STRIP).cast("int"), F.floor((end - 1) / STRIP).cast("int")
    some = F.when(first == last, F.get(strips, first)).otherwise(F.array_join(F.slice(strips, first + 1, F.greatest(F.lit(0), last - first + 1)), ""))
    return F.when(end > start, F.substring(some, start - first * STRIP + 1, end - start)).otherwise("")


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: F.coalesce(p.try_cast("int"), F.lit(256)) <= 255)
    if kind == "card":
        return F.length(digits).between(14, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _base_spans(text: Column) -> Column:
    """All valid base matches as (start, kind number, end, value), by start, then kind."""
    found = []
    none = F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")
    for number, kind in enumerate(KINDS):
        worth = F.contains(text, F.lit(HINT[kind])) if kind in HINT else text.rlike(r"[0-9]\.[0-9]" if kind == "ip" else r"[0-9](?:[\x20-]?[0-9]){13}")
        valid = F.filter(_matches(text, BASE[kind]), _validator(kind))
        found.append(F.when(worth, F.transform(valid, _numbered(number))).otherwise(none))
    return F.sort_array(F.concat(*found))


def _validator(kind: str):
    return lambda m: _valid(kind, m["value"])


def _numbered(number: int):
    return lambda m: F.struct(m["start"].alias("start"), F.lit(number).alias("kind"), m["end"].alias("end"), m["value"].alias("value"))


def _with_base(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds __p_text (no mark characters; same length), __p_hash and __p_base."""
    clean = F.replace(F.coalesce(F.col(text_col), F.lit("")), F.lit(MARK), F.lit("\u0002"))
    return docs.withColumn("__p_text", clean).withColumn("__p_hash", F.xxhash64("__p_text", F.length("__p_text"))).withColumn("__p_base", _base_spans(F.col("__p_text")))


def _with_context(text: Column, spans: Column) -> Column:
    """Each span with its value and the text on either side."""
    around = lambda strips, size: lambda m: F.struct(
        m["start"].alias("start"), m["end"].alias("end"), m["kind"].alias("kind"), F.lower(m["value"]).alias("value"),
        F.lower(_between(strips, F.greatest(m["start"] - CONTEXT, F.lit(0)), m["start"])).alias("before"),
        F.lower(_between(strips, m["end"], F.least(m["end"] + CONTEXT, size))).alias("after"),
    )
    return _let(F.length(text), lambda size: _let(_cut_up(text), lambda strips: F.transform(spans, around(strips, size))))


def _trimmed(value: Column) -> Column:
    """Without the marks that end a sentence; the :: that ends a group of hex digits stays."""
    kept = F.rtrim(value, F.lit(" .!?)"))
    return F.when(F.endswith(kept, F.lit("::")) & kept.rlike(SHAPES["ip"]), kept).otherwise(F.rtrim(value, F.lit(" .:!?)")))


def _candidates(text: Column, base: Column) -> Column:
    meets = lambda m, b: (b["start"] < m["end"]) & (m["start"] < b["end"])
    blocks = F.transform(_blocks(base, BLOCK), lambda some: F.struct(some[0]["start"].alias("start"), F.array_max(F.transform(some, lambda b: b["end"])).alias("end"), some.alias("own")))
    free = _let(blocks, lambda known: F.filter(_matches(text, CANDIDATE), lambda m: ~F.exists(known, lambda k: meets(m, k) & F.exists(k["own"], lambda b: meets(m, b)))))
    trimmed = F.transform(free, lambda m: F.struct(m["start"].alias("start"), F.lit(-1).alias("kind"), (m["start"] + F.length(_trimmed(m["value"]))).alias("end"), _trimmed(m["value"]).alias("value")))
    worth = text.rlike(CANDIDATE_HINT)
    return F.when(worth, F.filter(trimmed, lambda m: m["end"] > m["start"])).otherwise(F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>"))


def base_spans(docs: DataFrame) -> DataFrame:
    """doc_id, text hash, base spans, and candidates with context: a small table without texts, written once."""
    d = _with_base(docs.select("doc_id", "text")).withColumn("__p_free", _candidates(F.col("__p_text"), F.col("__p_base")))
    around = F.concat(_with_context(F.col("__p_text"), F.col("__p_base")), _with_context(F.col("__p_text"), F.col("__p_free")))
    spans = F.transform("__p_base", lambda m: F.struct(m["start"].alias("start"), m["kind"].alias("kind"), m["end"].alias("end")))
    return materialize(d.select("doc_id", F.col("__p_hash").alias("text_hash"), spans.alias("base"), around.alias("around")), "personal-data")


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.regexp_replace(text, r"[^\p{L}\p{N}:=#]+", " "), " "), "")


def find_unseen(spans: DataFrame, rounds: int = ROUNDS, min_seeds: int = MIN_SEEDS, min_share: float = MIN_SHARE, min_score: float = MIN_SCORE) -> DataFrame:
    """doc_id, text_hash, start, kind, end of the identifiers that the patterns discover."""
    seen = spans.select("doc_id", "text_hash", F.explode("around").alias("m")).select("doc_id", "text_hash", "m.*")
    left, right = _words(F.col("before")), _words(F.col("after"))
    seen = seen.withColumns({"l": left, "r": right})
    l1, l2, r1 = F.try_element_at("l", F.lit(-1)), F.try_element_at("l", F.lit(-2)), F.try_element_at("r", F.lit(1))
    patterns = F.array(F.concat(F.lit("<1 "), l1), F.concat(F.lit("<2 "), l2, F.lit(" "), l1), F.concat(F.lit("<> "), l1, F.lit(" _ "), r1))
    edges = seen.select("value", "kind", F.explode(F.filter(patterns, lambda p: p.isNotNull())).alias("pattern"))
    most = spans.agg(F.coalesce(F.sum(3 * F.size("around")), F.lit(0))).first()[0]
    edges = materialize(edges.groupBy("pattern", "value").agg(F.max("kind").alias("kind")), "personal-data-edges", most)
    size = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    seeds = edges.where("kind >= 0").select("value", F.col("kind").alias("as"), F.lit(1.0).alias("score")).distinct()
    free = edges.where("kind < 0").select("pattern", "value")
    fits = F.array(*[F.when(F.col("value").rlike(SHAPES[k]), F.lit(i)) for i, k in enumerate(KINDS)])
    scores, found = seeds, None
    for _ in range(rounds):
        votes = edges.select("pattern", "value").join(scores, "value").groupBy("pattern", "as").agg(F.sum("score").alias("sum"))
        share = F.col("sum") / (F.col("n") + 1)
        sure = votes.where(F.col("sum") >= min_seeds).join(size, "pattern").select("pattern", "as", share.alias("share")).where(F.col("share") >= min_share)
        sure = materialize(sure, "personal-data-patterns", most)
        known = F.broadcast(sure) if sure.count() <= BROADCAST_PATTERNS else sure
        found = (
            free.join(known, "pattern").where(F.array_contains(F.array_compact(fits), F.col("as")))
            .groupBy("value", "as").agg((1 - F.exp(F.sum(F.log1p(-F.least("share", F.lit(0.999)))))).alias("score"))
            .groupBy("value").agg(F.max_by("as", F.struct("score", -F.col("as"))).alias("as"), F.max("score").alias("score"))
        )
        scores = seeds.unionByName(found.select("value", "as", "score"))
    accepted = found.where(F.col("score") >= min_score).select("value", "as")
    hits = seen.where("kind < 0").select("doc_id", "text_hash", "start", "end", "value").join(accepted, "value")
    return hits.select("doc_id", "text_hash", "start", F.col("as").alias("kind"), "end").distinct()


def _per_text(unseen: DataFrame) -> DataFrame:
    """A row per text: what was discovered in it. A text's spans are as many as fit in it."""
    return unseen.groupBy(F.col("doc_id").alias("__p_id"), F.col("text_hash").alias("__p_key")).agg(F.collect_list(F.struct("start", "kind", "end")).alias("__p_more"))


def _joined(spans: Column) -> Column:
    name = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda m: F.concat_ws(":", name[m["kind"]], m["start"], m["end"])), ",")


def personal_data(docs: DataFrame, **limits) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans (base and discovered ones), n_found, for every row of docs.

    docs needs doc_id and text; other columns are not read. A null or empty text has no spans. Rows equal in doc_id and
    text get equal results; a null doc_id is kept; a text of any length is read whole. An empty table gives no rows. Offsets are code points, ends exclusive.
    """
    base = base_spans(docs)
    more = _per_text(find_unseen(base, **limits))
    same = F.col("doc_id").eqNullSafe(F.col("__p_id")) & (F.col("text_hash") == F.col("__p_key"))
    both = base.select("doc_id", "text_hash", "base").join(more, same, "left")
    added = F.coalesce("__p_more", F.array().cast("array<struct<start:int,kind:int,end:int>>"))
    counts = [F.size(F.filter("base", _is_kind(i))).cast("bigint").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return both.select("doc_id", *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.sort_array(F.concat("base", added))).alias("spans"), F.size(added).cast("bigint").alias("n_found"))


def _is_kind(number: int):
    return lambda m: m["kind"] == number


def redact(docs: DataFrame, **limits) -> DataFrame:
    """docs with every base and discovered span of text replaced by [KIND]; n_chars, if there, follows. Other columns stay.

    Overlapping spans become one, named after the first. A null text stays null, an empty one empty; a text of any length
    is read whole; rows equal in doc_id and text stay equal. Columns may have any names. An empty table stays empty.
    """
    docs, names = set_aside(docs, "__p_")
    more = _per_text(find_unseen(base_spans(docs), **limits))
    d = _with_base(docs).join(more, F.col("doc_id").eqNullSafe(F.col("__p_id")) & (F.col("__p_hash") == F.col("__p_key")), "left")
    base = F.transform("__p_base", lambda m: F.struct(m["start"].alias("start"), m["kind"].alias("kind"), m["end"].alias("end")))
    d = d.withColumn("__p_all", F.sort_array(F.concat(base, F.coalesce("__p_more", F.array().cast("array<struct<start:int,kind:int,end:int>>")))))
    text, name = F.col("text"), F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def replaced(strips: Column, spans: Column, ends: Column) -> Column:
        """ends: how far the spans before each reach; a span that begins before that belongs to one of them."""
        own = F.transform(spans, lambda m, k: F.when(m["start"] >= ends[k], F.concat(_between(strips, ends[k], m["start"]), name[m["kind"]])))
        return F.concat(F.array_join(F.array_compact(own), ""), _between(strips, F.element_at(ends, -1), F.length(text)))

    def cut(spans: Column) -> Column:
        reach = _let(F.transform(spans, lambda m: m["end"]), lambda e: _running(e, _largest))
        return _let(reach, lambda ends: _let(_cut_up(text), lambda strips: replaced(strips, spans, ends)))

    cut = _let(F.col("__p_all"), cut)
    d = d.withColumn("__p_new", F.when(text.isNull() | (F.size("__p_all") == 0), text).otherwise(cut))
    out = {"text": F.col("__p_new")} | ({"n_chars": F.when(F.size("__p_all") > 0, F.length("__p_new").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))} if "n_chars" in docs.columns else {})
    return d.select(*[out[c].alias(c) if c in out else F.col(c) for c in docs.columns]).withColumnsRenamed(names)
