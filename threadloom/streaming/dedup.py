"""The sequential deduplicator over a stream: what it kept is state, so it goes on after a restart."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..config import RELAXED, Gate
from ..operators.dedup import EXACT, FUZZY, KEPT, PASSED_OVER
from ..operators.similarity import Close

#: The state store that maps and many values need; set it in the session that starts the stream.
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
_STATUS = "lane string, seq long, at int, status int"


class _Walk(StatefulProcessor):
    """The walk of one lane. State: the digests of all kept texts (a map), the last kept texts by their numbers (a map from which the one that falls out is removed), how many were kept and which
    head was kept last."""

    def __init__(self, limits: Gate):
        self.limits = limits

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", "digest string", "number long")
        self.last = handle.getMapState("last", "number long", "text string")
        self.counts = handle.getValueState("counts", "kept long, head long, has_head boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        kept, head, has_head = self.counts.get() if self.counts.exists() else (0, 0, False)
        head = head if has_head else None
        least, history = self.limits.similarity, self.limits.history
        held = {}
        for n in range(max(0, kept - history), kept):
            held[n] = Close(self.last.getValue((n,))[0], least)
        out = []
        for pdf in rows:
            for seq, at, text in pdf.sort_values(["seq", "at"])[["seq", "at", "text"]].itertuples(index=False):
                form = (text or "").lower().strip()
                digest = hashlib.blake2b(form.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()
                if at and head != seq:
                    status = PASSED_OVER
                elif self.seen.containsKey((digest,)):
                    status = EXACT
                else:
                    close = Close(form, least)
                    status = FUZZY if any(close.to(other) for other in held.values()) else KEPT
                if status == KEPT:
                    self.seen.updateValue((digest,), (kept,))
                    self.last.updateValue((kept,), (form,))
                    held[kept] = close
                    if kept >= history:
                        self.last.removeKey((kept - history,))
                        del held[kept - history]
                    kept += 1
                    head = seq if at == 0 else head
                out.append((key[0], seq, at, status))
        self.counts.update((kept, head or 0, head is not None))
        yield pd.DataFrame(out, columns=["lane", "seq", "at", "status"])

    def close(self) -> None:
        pass


def walked(texts: DataFrame, *, limits: Gate = RELAXED, lane: str | None = None) -> DataFrame:
    """lane, seq, at, status of a stream of texts (seq, at, text): the batch walk of `operators.dedup.walked`, one micro-batch after another, in order of (seq, at) within each.

    The walk is sequential by its meaning, so a lane is one task; `lane` names a column (a forum, say) whose values are walked apart from each other. State is kept in the store STORE: a digest for
    each kept text, and the last `limits.history` texts. A null text counts as empty, a null lane as one of its own; rows without seq are left out.
    """
    name = F.lit("all") if lane is None else F.coalesce(F.col(lane).cast("string"), F.lit(""))
    rows = texts.where(F.col("seq").isNotNull()).select(name.alias("lane"), F.col("seq").cast("long").alias("seq"), F.col("at").cast("int").alias("at"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.groupBy("lane").transformWithStateInPandas(_Walk(limits), _STATUS, "append", "none")
