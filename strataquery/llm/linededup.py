"""Line dedup by a log-template tree.

Lines descend a tree of fixed depth: token count, then the first tokens. Numbers are variable fields from
the start. In a leaf that holds different lines, a field is constant where more than half of the leaf's
distinct lines agree on its token, and variable elsewhere; a line follows the leaf's template where enough of
its fields equal constants. Lines that don't go one level down, to the node of the token that most of them
share with others (the first such place), where the same holds; so a leaf may hold several templates. Lines
that follow none are templates of their own. A template whose lines stand in
``min_docs`` documents or more recurs, and its lines are dropped from all of them but the one with the
smallest id, so a text that has copies stays once. With ``exact_docs``, as in the registered query and the
pipeline, a line that stands unmasked in that many documents recurs too, tokens end at any white space, and every
line that is not blank counts; similarity is then that of the fields after the path, a word among them, and lines
without letters are not masked.

Only hashes of lines move, and tokens of the distinct lines of leaves that differ; every aggregation
combines before its shuffle, so a line that a third of all documents hold is a few rows a task. Documents
come back by one join with the hashes to drop.

Defined cases: null and empty texts come back as they are; lines of fewer than ``min_tokens`` tokens are
kept (blank lines alone with ``exact_docs``); repeated rows of one id count as one document and are treated
alike; rows without an id are one document where their texts are equal, after all documents with ids (below
2**62); an empty table gives no rows; further columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

MIN_DOCS = 3
MIN_TOKENS = 3
#: Documents from which on a line recurs that stands in them as it is, not through a template.
EXACT_DOCS = 2
#: White space besides the space character, and that of it which is ASCII.
_SPACES = r"\t\x0B\f\r\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_ASCII_SPACES = "\t\x0b\f\r"
_LETTER = r"\p{L}"
#: First tokens on the path to a leaf.
DEPTH = 3
#: Share of a line's fields that must equal constants of the leaf's template.
LEAST_SIMILAR = 0.6
#: Bits of leaf hashes by which lines are sifted before texts are shuffled.
FILTER_BITS = 17


#: Lines dropped from one document that are looked up together.
DROP_BUCKET = 1024


def _doc() -> Column:
    """The id, or for a null one a number past all ids that only its text decides."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(1 << 62) + F.xxhash64("text").bitwiseAND(F.lit((1 << 62) - 1)))


def masked(line: Column) -> Column:
    return F.regexp_replace(F.trim(line), "[0-9]+", "<*>")


def _tokens(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1


def _has(line: Column, pattern: str) -> Column:
    """Whether a character fits; mostly one of the first does, and the rest need not be decoded."""
    return F.substring(line, 1, 8).rlike(pattern) | line.rlike(pattern)


def _spaced(line: Column) -> Column:
    """The line, trimmed, with space characters for other white space; most lines are found to have none without a pattern."""
    some = F.length(line) != F.octet_length(line)
    for c in _ASCII_SPACES:
        some = some | F.contains(line, F.lit(c))
    return F.trim(F.when(some, F.regexp_replace(line, f"[{_SPACES}]", " ")).otherwise(line))


def _mask(spaced: Column) -> Column:
    """Numbers masked beside words; rows of numbers alone stay as they are."""
    return F.when(_has(spaced, _LETTER), F.regexp_replace(spaced, "[0-9]+", "<*>")).otherwise(spaced)


def _line_keys(df: DataFrame, depth: int) -> DataFrame:
    """df (line, ...) without blank lines, with w (its line, trimmed), m_line (masked), n, leaf, own, and id: the hash of the line as it is."""
    df = df.where(_has(F.col("line"), f"[^ {_SPACES}]")).withColumn("w", _spaced(F.col("line")))
    df = df.withColumn("m_line", _mask(F.col("w")))
    df = df.withColumn("n", _tokens(F.col("m_line")))
    df = df.withColumn("leaf", F.xxhash64("n", F.substring_index("m_line", " ", depth))).withColumn("own", F.xxhash64("m_line"))
    return df.withColumn("id", _line_id(F.col("w"), F.col("m_line")))


def _leaves(df: DataFrame, depth: int) -> DataFrame:
    """df (line, ...) without blank lines, with w, n and leaf as _line_keys() gives them: masking keeps spaces, so the path is that of the masked first tokens."""
    df = df.where(_has(F.col("line"), f"[^ {_SPACES}]")).withColumn("w", _spaced(F.col("line"))).withColumn("n", _tokens(F.col("w")))
    path = F.substring_index("w", " ", depth)
    return df.withColumn("leaf", F.xxhash64("n", F.when(_has(F.col("w"), _LETTER), F.regexp_replace(path, "[0-9]+", "<*>")).otherwise(path)))


def _line_id(spaced: Column, masked_line: Column) -> Column:
    """Equals the hash of the masked line where there is nothing to mask."""
    return F.when(spaced == masked_line, F.xxhash64(masked_line)).otherwise(F.xxhash64(spaced, F.lit("line")))


def _keys(line: Column, depth: int) -> list[Column]:
    """n, leaf and own: token count, the hash of the path, the hash of the masked line; both with the count inside."""
    m = masked(line)
    n = _tokens(m)
    return [n.alias("n"), F.xxhash64(n, F.substring_index(m, " ", depth)).alias("leaf"), F.xxhash64(n, m, F.lit("own")).alias("own")]


def recurring(docs: DataFrame, min_docs: int = MIN_DOCS, min_tokens: int = MIN_TOKENS, depth: int = DEPTH, least_similar: float = LEAST_SIMILAR, exact_docs: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(own, keep_doc): the hash of each masked line whose template recurs, and the smallest id of the template; and (own, leaf, n, doc): a row for each document and masked line, with ``exact_docs`` (.., id) for each line as it is."""
    lines = docs.select(_doc().alias("doc"), F.explode(F.split("text", "\n")).alias("line"))
    keys = ["own", "leaf", "n"]
    if exact_docs:
        keyed = _line_keys(lines, depth)
        # most lines have no digits: their id is null here and costs nothing
        keyed = keyed.withColumn("other", F.when(F.col("id") != F.col("own"), F.col("id")))
        keys = [*keys, "other"]
    else:
        keyed = lines.select("doc", F.struct(*_keys(F.col("line"), depth)).alias("k")).select("doc", "k.*").where(F.col("n") >= min_tokens)
        text = lines.select(F.col("line"), F.struct(*_keys(F.col("line"), depth)).alias("k")).select("k.n", "k.leaf", "k.own", masked(F.col("line")).alias("m_line")).where(F.col("n") >= min_tokens)
    # one row for each document and line
    seen = written(keyed.groupBy(*keys, "doc").agg(F.count("*").alias("times")).drop("times"), "lines")
    if exact_docs:
        seen = seen.select("own", "leaf", "n", "doc", F.coalesce("other", "own").alias("id"))
    own = seen.groupBy("own", "leaf", "n").agg(F.count("*").alias("docs"), F.min("doc").alias("first_doc"))
    own = written(own, "own")
    mixed = own.groupBy("leaf").agg(F.sum("docs").alias("docs"), F.count("*").alias("m")).where((F.col("m") > 1) & (F.col("docs") >= min_docs))
    mixed = written(mixed.select("leaf", "m"), "mixed")
    # lower bits of the leaves first: 2**FILTER_BITS rows at most, so this side may always be broadcast, and few texts are shuffled
    low = F.col("leaf").bitwiseAND(F.lit((1 << FILTER_BITS) - 1)).alias("low")
    sift = lambda df: df.withColumn("low", low).join(F.broadcast(mixed.select(low).distinct()), "low", "left_semi").drop("low")
    if exact_docs:
        # the leaf from the path alone; whole lines are masked where their leaf may be one
        text = sift(_leaves(lines, depth)).withColumn("m_line", _mask(F.col("w"))).select("n", "leaf", F.xxhash64("m_line").alias("own"), "m_line")
    else:
        text = sift(text)
    fields = text.join(mixed.select("leaf"), "leaf", "left_semi").groupBy("leaf", "own", "n").agg(F.min("m_line").alias("m_line"))
    fields = written(fields.select("leaf", "own", "n", F.posexplode(F.split("m_line", " ")).alias("at", "token")), "fields")
    after = depth if exact_docs else 0
    constant = written(_constants(fields.withColumnRenamed("leaf", "node"), mixed.withColumnRenamed("leaf", "node")), "constants")
    first = written(_followers(fields.withColumnRenamed("leaf", "node"), constant, after, least_similar), "general")
    # a leaf of several templates: what follows none yet goes one level down, by the token that most of the others share and that is no constant yet
    rest = written(fields.join(first, "own", "left_anti"), "rest")
    words = rest.where(F.col("at") >= depth).where(F.col("token").rlike(_LETTER)).join(constant.withColumnRenamed("node", "leaf").hint("merge"), ["leaf", "at", "token"], "left_anti")
    shared = words.groupBy("leaf", "at", "token").agg(F.count("*").alias("c")).where("c > 1")
    branch = rest.join(shared, ["leaf", "at", "token"]).groupBy("leaf", "own").agg(F.max(F.struct("c", (-F.col("at")).alias("at"), "token")).alias("best"))
    branch = written(branch.select("own", F.xxhash64("leaf", "best.at", "best.token").alias("node")), "branches")
    below = rest.join(branch, "own")
    second = _followers(below, _constants(below, branch.groupBy("node").agg(F.count("*").alias("m")).where("m > 1")), after, least_similar)
    general = written(first.union(second), "general")
    # a line that follows a template counts for it, any other for itself
    of = seen.join(general, "own", "left").withColumn("template", F.coalesce("template", "own"))
    docs_of = of.groupBy("template", "doc").agg(F.count("*").alias("x")).groupBy("template").agg(F.count("*").alias("docs"), F.min("doc").alias("keep_doc"))
    often = docs_of.where(F.col("docs") >= min_docs).select("template", "keep_doc")
    lines_of = own.select("own").join(general, "own", "left").select("own", F.coalesce("template", "own").alias("template"))
    return lines_of.join(often, "template").select("own", "keep_doc"), seen


def _constants(fields: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, at, token: what more than half of a node's m lines have in common, of fields (node, own, n, at, token) and nodes (node, m)."""
    usual = fields.groupBy("node", "at", "token").agg(F.count("*").alias("c")).groupBy("node", "at").agg(F.max(F.struct("c", "token")).alias("best"))
    return usual.join(nodes, "node").where(F.col("best.c") * 2 > F.col("m")).select("node", "at", F.col("best.token").alias("token"))


def _followers(fields: DataFrame, constant: DataFrame, after: int, least_similar: float) -> DataFrame:
    """own, template: the lines of fields (node, own, n, at, token) that follow the template of their node (node, at, token).

    All lines of a leaf agree on its path: with ``after`` the fields from there on tell, of which one must be a word.
    """
    # both sides are large: tokens of all lines, and what many of them share
    same = fields.join(constant.hint("merge"), ["node", "at", "token"]).where(F.col("at") >= after)
    word = F.max(F.col("token").rlike(_LETTER)) if after else F.lit(True)
    same = same.groupBy("node", "own", "n").agg(F.count("*").alias("same"), word.alias("word"))
    return same.where((F.col("same") >= (F.col("n") - after) * least_similar) & F.col("word")).select("own", F.col("node").alias("template"))


def drop_recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_tokens: int = MIN_TOKENS, depth: int = DEPTH, least_similar: float = LEAST_SIMILAR, exact_docs: int | None = None) -> DataFrame:
    """docs with text rid of recurring lines, and n_lines and n_dropped."""
    often, seen = recurring(docs, min_docs, min_tokens, depth, least_similar, exact_docs)
    lines = F.split("text", "\n")
    if exact_docs:
        twice = written(seen.groupBy("id").agg(F.count("*").alias("docs"), F.min("doc").alias("keep_doc")).where(F.col("docs") >= exact_docs).select("id", "keep_doc"), "twice")
        gone = seen.join(often, "own").where(F.col("doc") > F.col("keep_doc")).select("doc", "id")
        gone = gone.union(seen.join(twice, "id").where(F.col("doc") > F.col("keep_doc")).select("doc", "id"))
        # each line's hash once: higher-order functions share no common parts, and a lambda would compute an outer array for each element
        parts = F.transform(lines, lambda line: F.struct(line.alias("line"), _spaced(line).alias("w")))
        parts = F.transform(parts, lambda x: F.struct(x["line"].alias("line"), x["w"].alias("w"), _mask(x["w"]).alias("m_line")))
        hashed = F.transform(parts, lambda x: F.struct(x["line"].alias("line"), _line_id(x["w"], x["m_line"]).alias("id")))
    else:
        gone = seen.join(often, "own").where(F.col("doc") > F.col("keep_doc")).select("doc", F.col("own").alias("id"))
        hashed = F.transform(lines, lambda line: F.struct(line.alias("line"), _keys(line, depth)[2].alias("id")))
    # buckets by hash, so that a line of a document that loses many is looked up among few
    buckets = F.floor(F.size("ids") / DROP_BUCKET).cast("int") + 1
    drops = gone.groupBy("doc").agg(F.collect_set("id").alias("ids"))
    dealt = F.transform(F.sequence(F.lit(0), buckets - 1), lambda b: F.filter("ids", lambda x: F.pmod(x, buckets) == b))
    drops = written(drops.select(F.col("doc").alias("__doc"), dealt.alias("__drop")), "drops")
    joined = docs.join(drops, _doc() == F.col("__doc"), "left")
    dropped = lambda x: F.array_contains(F.get("__drop", F.pmod(x["id"], F.size("__drop")).cast("int")), x["id"])
    left = F.transform(F.filter(hashed, lambda x: ~dropped(x)), lambda x: x["line"])
    joined = joined.withColumn("__left", F.when(F.col("__drop").isNotNull(), left))
    kept = F.when(F.col("__drop").isNull(), F.col("text")).otherwise(F.array_join("__left", "\n"))
    n = F.coalesce(F.size(lines), F.lit(0))
    n_left = F.when(F.col("__drop").isNull(), n).otherwise(F.size("__left"))
    others = [c for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
    return joined.select(*others, kept.alias("text"), F.when(F.col("text").isNull(), 0).otherwise(n).cast("long").alias("n_lines"), F.when(F.col("text").isNull(), 0).otherwise(n - n_left).cast("long").alias("n_dropped"))
