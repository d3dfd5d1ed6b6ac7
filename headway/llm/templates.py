"""Lines that recur across documents, by a log-template tree.

A line goes down a tree of fixed depth: its number of tokens, then its first three tokens,
those with digits as one wild card. In a leaf the template has, at each place, the token that
at least half the leaf's lines have there, else a wild card. A line that agrees with six
tenths of it is of that template. The leaf's other lines may hold any number of templates: there
a token is constant at its place if five different lines or more have it there, copies counted
once, and the constants of a line are its template if they are six tenths of its tokens. Any other line is a
template of its own. Lines whose template occurs in five documents or more are dropped from
all of them but the one with the least id, which keeps a copy.

Everything is counted over all lines: they are first reduced to hashes, and texts are looked
up only for lines in leaves that several documents share. Bit tables of fixed size keep other
texts out of the shuffles; those few that are left are joined by sorting at any size, so that
a larger corpus has the same plan. Documents are told apart by id and
text, so repeated rows are one document and lose the same lines.

Defined cases: a null text has no lines and stays null; blank lines stay; null ids come before
others; no documents give no rows. Equal lines are found by 64-bit hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import bit_table, in_table_column, salted_join, written

DEPTH = 3
MIN_DOCS = 5
SPACES = r"[\x20\x09-\x0D]++"
WORD = r"[^\x20\x09-\x0D]++"
WILD = "<*>"


def tokens(words: Column) -> Column:
    """Tokens of a run of words, those that hold a digit as wild cards."""
    split = F.split(F.regexp_replace(words, rf"^{SPACES}", ""), SPACES)
    return F.transform(F.filter(split, lambda t: t != ""), lambda t: F.when(t.rlike("[0-9]"), WILD).otherwise(t))


def leaf(line: str) -> Column:
    """The leaf of a line, of which only the leading tokens are taken apart."""
    lead = F.regexp_extract(line, rf"^(?:{SPACES})?(?:{WORD}(?:{SPACES})?){{1,{DEPTH}}}", 0)
    return F.xxhash64(F.regexp_count(line, F.lit(WORD)), tokens(lead))


def _lines(docs: DataFrame) -> DataFrame:
    return docs.select("_doc", "doc_id", F.posexplode(F.split("text", "\n")).alias("at", "line")).withColumn("mark", F.xxhash64("line"))


def drop_templates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """One row a document: id, text without the dropped lines, lines and dropped lines."""
    keyed = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).withColumn("_doc", F.xxhash64("doc_id", "text"))

    worded = _lines(keyed).where(F.col("line").rlike(r"[^\x20\x09-\x0D]"))
    lines = written(worded.select("_doc", "doc_id", "at", "mark", leaf("line").alias("leaf")), "lines")

    # Leaves that only one document reaches can't recur; a leaf of one line is its own template.
    ends = [F.count("*").alias("all"), F.min("_doc").alias("low"), F.max("_doc").alias("high"), (F.min("mark") != F.max("mark")).alias("varied")]
    common = lines.groupBy("leaf").agg(*ends).where("low != high").select("leaf", "all", "varied")
    lines = written(lines.join(common, "leaf"), "shared-lines")
    kinds = lines.groupBy("mark").agg(F.first("leaf").alias("leaf"), F.first("all").alias("all"), F.first("varied").alias("varied"), F.count("*").alias("n"))
    kinds = written(kinds, "line-kinds")
    varied = kinds.where("varied")
    maybe = in_table_column(docs.sparkSession, bit_table(varied, "mark"), "mark")
    texts = _lines(keyed).select("mark", "line").where(maybe).hint("merge").join(varied.select("mark"), "mark", "left_semi").groupBy("mark").agg(F.first("line").alias("line"))
    known = written(varied.join(texts, "mark").withColumn("tokens", tokens(F.col("line"))).drop("line"), "tokens")

    # The template of a leaf: the leading token of each place, if it leads by half.
    placed = known.select("leaf", "all", "n", F.posexplode("tokens").alias("place", "token"))
    counted = placed.groupBy("leaf", "place", "token").agg(F.sum("n").alias("n"), F.max("all").alias("all"))
    top = counted.groupBy("leaf", "place").agg(F.max(F.struct("n", "token")).alias("top"), F.max("all").alias("all"))
    leading = F.when(2 * F.col("top.n") >= F.col("all"), F.col("top.token"))
    shape = top.groupBy("leaf").agg(F.array_sort(F.collect_list(F.struct("place", leading.alias("token")))).alias("shape"))
    same = F.zip_with("tokens", "shape", lambda a, b: F.coalesce((a == b["token"]).cast("int"), F.lit(0)))
    agreed = F.aggregate(same, F.lit(0), lambda total, hit: total + hit)
    fits = 10 * agreed >= 6 * F.size("tokens")
    judged = known.join(shape, "leaf").select("leaf", "mark", fits.alias("fits"), F.when(~fits, F.col("tokens")).alias("tokens"))
    judged = written(judged, "judged-lines")
    every = judged.drop("tokens").unionByName(kinds.where("NOT varied").select("leaf", "mark", F.lit(True).alias("fits")))
    template = F.when(F.col("fits"), F.xxhash64("leaf", F.lit("leaf"))).otherwise(F.xxhash64("mark", F.lit("line")))
    shaped = _constants(judged.where("NOT fits").drop("fits"), min_docs)
    assigned = every.join(shaped, "mark", "left").select("mark", F.coalesce("constants", template).alias("template"))
    assigned = written(assigned, "templates")

    # A line that a third of the documents have is split by the adaptive skew join.
    seen = lines.select("_doc", "doc_id", "mark").join(assigned, "mark").groupBy("template", "_doc").agg(F.min("doc_id").alias("doc_id"))
    spread = seen.groupBy("template").agg(F.count("*").alias("docs"), F.min(F.struct("doc_id", "_doc")).alias("keeper")).where(F.col("docs") >= min_docs)
    gone = written(assigned.join(spread.select("template", F.col("keeper._doc").alias("keeper")), "template").select("mark", "keeper"), "recurring")

    dropped = lines.join(gone, "mark").where(F.col("_doc") != F.col("keeper")).select("_doc", "at").distinct()
    flagged = written(dropped.groupBy("_doc").agg(F.array_sort(F.collect_list("at")).alias("gone")), "dropped-lines")
    losing = in_table_column(docs.sparkSession, bit_table(flagged, "_doc"), "_doc")
    split = keyed.withColumn("_lines", F.split("text", "\n"))
    some = split.where(losing).hint("merge").join(flagged, "_doc", "left")
    kept = F.array_join(F.transform(F.filter(_flags(), lambda x: ~x["gone"]), lambda x: x["line"]), "\n")
    some = some.withColumn("text", F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept))
    n_lines, n_dropped = F.coalesce(F.size("_lines"), F.lit(0)).cast("long"), F.coalesce(F.size("gone"), F.lit(0)).cast("long")
    whole = split.where(~losing).withColumn("gone", F.lit(None).cast("array<int>"))
    columns = ["doc_id", "text", n_lines.alias("n_lines"), n_dropped.alias("n_dropped")]
    return whole.select(*columns).unionByName(some.select(*columns))


def _constants(rest: DataFrame, min_lines: int) -> DataFrame:
    """(mark, constants) of the lines whose constant tokens, with their places, are a template.

    A token that very many lines of a leaf have at a place is a hot key of the join, which is salted by line.
    """
    crowded = rest.groupBy("leaf").count().where(F.col("count") >= min_lines).select("leaf")
    placed = rest.join(crowded, "leaf", "left_semi").select("leaf", "mark", F.size("tokens").alias("size"), F.posexplode("tokens").alias("place", "token"))
    keys = ["leaf", "place", "token"]
    constant = placed.groupBy(*keys).agg(F.count("*").alias("lines")).where(F.col("lines") >= min_lines).drop("lines")
    held = salted_join(placed, constant, keys, "mark", "inner").groupBy("mark").agg(
        F.first("leaf").alias("leaf"), F.first("size").alias("size"), F.array_sort(F.collect_list(F.struct("place", "token"))).alias("held")
    )
    return held.where(10 * F.size("held") >= 6 * F.col("size")).select("mark", F.xxhash64("leaf", "held", F.lit("constants")).alias("constants"))


def _flags() -> Column:
    """The lines, each with whether its number is among the dropped ones.

    The numbers become a string with one character a line, so a lookup takes no search.
    """
    size = F.size("_lines")
    gaps = F.zip_with(
        "gone",
        F.concat(F.array(F.lit(-1)), F.col("gone")),
        lambda at, before: F.when(at.isNotNull(), F.concat(F.repeat(F.lit("0"), at - before - 1), F.lit("1"))),
    )
    marks = F.rpad(F.array_join(gaps, ""), size, "0")
    return F.zip_with("_lines", F.split(marks, ""), lambda line, mark: F.struct(line.alias("line"), F.coalesce(mark == "1", F.lit(False)).alias("gone")))
