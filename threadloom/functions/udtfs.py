"""Table functions for SQL: threads as text, and what a text relates."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Row, SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.types import IntegerType, StringType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn


class Threads:
    """threads(TABLE(comments), 'post'): a row for each value of the column named, with n_comments and the comments as compact text in reading order.

    comments: that column, path, depth, author, score, body. The function itself asks for rows partitioned by the column and ordered by path, so a call needs neither. A post's text is built as its
    rows come, one at a time; comments that are open hold their closing lines on a stack. Missing values read as in the compact text of posts; an empty table gives no rows.
    """

    @staticmethod
    def analyze(comments: AnalyzeArgument, post: AnalyzeArgument) -> AnalyzeResult:
        if not comments.isTable or post.value is None:
            raise ValueError("threads(TABLE(comments), 'post') needs a table and the name of its column")
        known = {f.name: f.dataType for f in comments.dataType.fields}
        missing = {post.value, "path", "depth", "author", "score", "body"} - set(known)
        if missing:
            raise ValueError(f"threads needs the columns {sorted(missing)}")
        schema = StructType().add(post.value, known[post.value]).add("n_comments", IntegerType()).add("text", StringType())
        return AnalyzeResult(schema=schema, partitionBy=[PartitioningColumn(post.value)], orderBy=[OrderingColumn("path")])

    def __init__(self) -> None:
        self.post, self.n, self.lines, self.open = None, 0, [], []

    def _close(self, depth: int) -> None:
        while self.open and self.open[-1] >= depth:
            self.lines.append("  " * self.open.pop() + "[/COMMENT]")

    def eval(self, row: Row, post: str) -> Iterator[tuple]:
        depth, pad = row["depth"], "  " * row["depth"]
        self._close(depth)
        self.post, self.n = row[post], self.n + 1
        value = lambda name, missing: missing if row[name] is None else row[name]
        self.lines += [f"{pad}[COMMENT]", f"{pad}Author: {value('author', 'N/A')}", f"{pad}Score: {value('score', 0)}", f"{pad}Body: {value('body', '')}"]
        self.open.append(depth)
        return iter(())

    def terminate(self) -> Iterator[tuple]:
        if self.n:
            self._close(0)
            yield self.post, self.n, "\n".join(self.lines)


class Relations:
    """relations_in(text): seq, source, target, relation, evidence of each relation that the rule backend finds; none for null."""

    def eval(self, text: str) -> Iterator[tuple]:
        from ..operators.backends import RuleBackend

        for i, r in enumerate(RuleBackend().extraction(text or "")[1]):
            yield i, r["source"], r["target"], r["relation"], r["evidence"]


class Entities:
    """entities_in(text): pos, name, type of each entity that the rule backend finds; none for null."""

    def eval(self, text: str) -> Iterator[tuple]:
        from ..operators.backends import RuleBackend

        for i, e in enumerate(RuleBackend().extraction(text or "")[0]):
            yield i, e["name"], e["type"]


def register(spark: SparkSession) -> None:
    """Names the table functions in SQL: threads, relations_in, entities_in."""
    spark.udtf.register("threads", udtf(Threads))
    spark.udtf.register("relations_in", udtf(Relations, returnType="seq int, source string, target string, relation string, evidence string"))
    spark.udtf.register("entities_in", udtf(Entities, returnType="pos int, name string, type string"))
