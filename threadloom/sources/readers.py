"""Posts, batches, graphs and reports from files. A missing input raises."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import once
from ..operators.reports import LENS

POST = "post_id string, author string, title string, score long, selftext string, author_account_age_days long, author_comment_karma long, comments string"


#: Bytes of input for each core from which on a table's own splits will do.
ENOUGH = 16 << 20


def dealt_out(df: DataFrame) -> DataFrame:
    """df, dealt out to all cores if it is small and stands in fewer files than there are cores: a file of one row group is one task, however many cores are free. A table of ENOUGH bytes for each
    core is read as it is cut, and never shuffled."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(cores) if size < cores * ENOUGH and len(df._jdf.inputFiles()) < cores else df


def _so_far(column: str) -> Column:
    """The sum over the rows of a split up to this one."""
    return F.sum(column).over(Window.partitionBy("split").orderBy("row").rowsBetween(Window.unboundedPreceding, Window.currentRow))


def _before(sizes: DataFrame, column: str) -> Column:
    """The sum over the splits before; a table of splits has a row for each, far fewer than those of files."""
    return F.sum(column).over(Window.orderBy("split").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col(column)


def pieces(spark: SparkSession, path: str, end: str) -> DataFrame:
    """value, split, row, file_size of what stands between the `end`s of the files at a path; Spark's reader cuts files into splits as large as it likes. split is (file, first byte), and row
    rises within one."""
    text = spark.read.option("lineSep", end).text(path)
    return text.select("value", F.struct("_metadata.file_path", "_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("row"), "_metadata.file_size")


def json_lines(spark: SparkSession, path: str) -> DataFrame:
    """seq, value of the lines of files, in order of the files' names and of the places in them, whatever sizes the files have and however they are cut. Blank lines are left out.

    Rows of a split are counted and come after those of the splits before it.
    """
    rows = pieces(spark, path, "\n").where(F.trim("value") != "")
    sizes = rows.groupBy("split").agg(F.count("*").alias("n"))
    sizes = sizes.select(F.col("split").alias("of"), _before(sizes, "n").alias("before"))
    placed = rows.withColumn("place", F.row_number().over(Window.partitionBy("split").orderBy("row")) - 1)
    return placed.join(sizes, F.col("split") == F.col("of")).select((F.col("before") + F.col("place")).alias("seq"), "value")


def json_elements(spark: SparkSession, path: str) -> DataFrame:
    """seq, value: the objects of JSON arrays, one array in a file (or one that goes on over the files of a folder, in order of their names), read by as many tasks as the files have splits.

    Files are cut at closing braces, wherever these stand. Of each piece is known how many quotes it has, and by how much it changes the depth of brackets if it begins outside of a string, and if
    inside. Sums of these over the splits and then within them tell for each piece whether it begins in a string, and the depth at its end: at depth 1 an element ends there. The
    pieces of an element come together by its number. A task holds the pieces of a split, and an element. Elements that are no objects are left out.
    """
    rows = pieces(spark, path, "}")
    # the last piece of a file has no brace behind it, unless the file ends with one: then pieces and braces make up its size
    sizes = rows.groupBy("split").agg(F.count("*").alias("n"), F.sum(F.octet_length("value")).alias("bytes"), F.max("row").alias("last"), F.max("file_size").alias("size"))
    file = Window.partitionBy("split.file_path")
    open_ = (F.col("split") == F.max("split").over(file)) & (F.sum(F.col("bytes") + F.col("n")).over(file) > F.col("size"))
    sizes = sizes.select(F.col("split").alias("of"), F.when(open_, F.col("last")).alias("last"))
    rows = rows.join(sizes, F.col("split") == F.col("of")).select("value", "split", "row", F.coalesce(F.col("row") != F.col("last"), F.lit(True)).cast("int").alias("brace"))
    # a backslash and what it escapes count for nothing; outside of strings there is none
    rows = once(rows, parts=F.split(F.regexp_replace("value", r"\\.", ""), '"'))
    odd = (F.size("parts") - 1) % 2
    # a piece's closing brace counts where it stands outside of a string
    rows = once(rows, odd=odd, out=_depth(0) - F.when(odd == 0, F.col("brace")).otherwise(0), inside=_depth(1) - F.when(odd == 1, F.col("brace")).otherwise(0)).drop("parts")
    # within a split first as if it began outside of a string, and as if inside
    rows = rows.withColumn("turned", (_so_far("odd") - F.col("odd")) % 2)
    rows = rows.withColumn("a", F.when(F.col("turned") == 0, F.col("out")).otherwise(F.col("inside"))).withColumn("b", F.when(F.col("turned") == 0, F.col("inside")).otherwise(F.col("out")))
    splits = rows.groupBy("split").agg((F.sum("odd") % 2).alias("odd"), F.sum("a").alias("a"), F.sum("b").alias("b"))
    splits = splits.withColumn("quoted", _before(splits, "odd") % 2)
    splits = splits.withColumn("change", F.when(F.col("quoted") == 0, F.col("a")).otherwise(F.col("b")))
    splits = splits.select(F.col("split").alias("of"), "quoted", _before(splits, "change").alias("deep"))
    rows = rows.join(splits, F.col("split") == F.col("of")).drop("of")
    rows = rows.withColumn("change", F.when(F.col("quoted") == 0, F.col("a")).otherwise(F.col("b")))
    depth = F.col("deep") + _so_far("change")
    outside = (F.col("turned") + F.col("quoted") + F.col("odd")) % 2 == 0
    rows = rows.withColumn("ends", (outside & (depth == 1) & (F.col("brace") == 1)).cast("long"))
    ended = rows.groupBy("split").agg(F.sum("ends").alias("n"))
    ended = ended.select(F.col("split").alias("of"), _before(ended, "n").alias("before"))
    rows = rows.join(ended, F.col("split") == F.col("of"))
    rows = rows.withColumn("seq", F.col("before") + _so_far("ends") - F.col("ends"))
    text = F.concat("value", F.when(F.col("brace") == 1, "}").otherwise(""))
    whole = rows.groupBy("seq").agg(F.max("ends").alias("ends"), F.array_sort(F.collect_list(F.struct("split", "row", text.alias("text")))).alias("p")).where("ends = 1")
    # before an element stands a comma, or the bracket that opens its array and the end of the array before
    return whole.select("seq", F.regexp_replace(F.array_join(F.transform("p", lambda x: x["text"]), ""), r"^[\s\],\[]*", "").alias("value"))


def _depth(rest: int) -> Column:
    """Opening less closing brackets in every other part between quotes."""
    text = F.array_join(F.filter("parts", lambda x, i: i % 2 == rest), "")
    count = lambda signs: F.length(text) - F.length(F.translate(text, signs, ""))
    return count("[{") - count("]}")


def json_posts(spark: SparkSession, path: str, *, lines: bool = False) -> DataFrame:
    """Posts with `seq`, the comment trees as JSON text (`comments`) and the whole post as JSON text (`raw`), from files that hold one array of posts each, or one post a line.

    seq goes by files in order of their names, and by place in the file. Unknown fields stay in `raw`, and in the comments' texts.
    """
    rows = json_lines(spark, path) if lines else json_elements(spark, path)
    return once(rows, p=F.from_json("value", POST)).select("seq", "p.*", F.col("value").alias("raw"))


def parquet_posts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def lens_report(spark: SparkSession, path: str) -> DataFrame:
    """lens, summary, key_insight, risk_level, prediction, error of a file that holds one object by lens."""
    kind = LENS.replace(">", ",raw_analysis:string,error:string>")
    whole = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", f"map<string,{kind}>")).alias("key", "r"))
    return whole.select(F.col("key").alias("lens"), "r.summary", "r.key_insight", "r.risk_level", "r.prediction", "r.raw_analysis", "r.error")


def graph(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(vertices, edges)."""
    return spark.read.parquet(f"{folder}/vertices"), spark.read.parquet(f"{folder}/edges")
