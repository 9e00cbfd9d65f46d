"""What answers prompts: a protocol, a deterministic default by rules, and the operators that run a backend over rows."""

from __future__ import annotations

import json
import re
from collections import Counter
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.repair import EXTRACTION, extraction
from ..functions.text import fence_stripped


class Backend(Protocol):
    """Must be picklable: it is sent to executors. Called once for each text."""

    def generate(self, system: str, user: str) -> str: ...


EXTRACTION_SYSTEM = "Extract the entities and relations of a text as JSON with the keys entities and relations."
#: What a failing backend's answer is replaced by.
FAILED = "Error: Analysis failed."
SCENARIO_SYSTEM = "You are a strategist who writes a report of scenarios for a decision maker."


class RuleBackend:
    """Deterministic: capitalised spans are entities, two of them in a sentence a relation, named by the words between them."""

    SPAN = re.compile(r"[A-ZÀ-Þ][\w'-]*(?: [A-ZÀ-Þ][\w'-]*)*")
    KINDS = (("Organization", ("inc", "corp", "ltd", "university", "bank", "party", "agency")), ("Location", ("city", "street", "river", "north", "south", "east", "west")))

    def kind(self, name: str) -> str:
        last = name.lower().split()[-1]
        return next((k for k, ends in self.KINDS if last in ends), "Person" if name.count(" ") == 1 else "Concept")

    def generate(self, system: str, user: str) -> str:
        if system == SCENARIO_SYSTEM:
            return self.scenario(user)
        if system != EXTRACTION_SYSTEM:
            return self.analysis(user)
        entities, relations = self.extraction(user)
        return json.dumps({"entities": entities, "relations": relations}, ensure_ascii=False)

    def extraction(self, text: str) -> tuple[list[dict], list[dict]]:
        """(entities, relations) of a text, all of them; entities by count and name."""
        counts: Counter[str] = Counter()
        relations = []
        for sentence in re.split(r"[.!?\n]+", text):
            spans = [(m[0], m.start(), m.end()) for m in self.SPAN.finditer(sentence)]
            if not spans:
                continue
            counts.update(name for name, _, _ in spans)
            evidence = sentence.strip()
            for (a, _, end), (b, start, _) in zip(spans, spans[1:]):
                relations.append({"source": a, "target": b, "relation": sentence[end:start].strip(" ,;:|") or "with", "evidence": evidence})
        return [{"name": n, "type": self.kind(n)} for n in sorted(counts, key=lambda n: (-counts[n], n))], relations

    def scenario(self, user: str) -> str:
        """One scenario for each risk level that the lenses gave, likely by how many gave it."""
        risks = re.findall(r"^Risk Level: (.*)$", user, re.M)
        level = lambda k: {"name": f"{k} risk", "description": f"{risks.count(k)} of {len(risks)} analyses say {k}.", "probability": f"{100 * risks.count(k) // max(len(risks), 1)}%"}
        first = re.search(r"^Key Insight: (.*)$", user, re.M)
        found = {f"scenario_{c}": level(k) for c, k in zip("abc", ("High", "Medium", "Low"))}
        return json.dumps({"event_topic": first[1] if first else None, "current_state": f"{len(risks)} analyses.", **found, "early_warning_signals": sorted(set(risks))}, ensure_ascii=False)

    def analysis(self, user: str) -> str:
        lines = [x for x in user.splitlines() if "--[" in x]
        risk = "High" if len(lines) > 40 else "Medium" if len(lines) > 10 else "Low"
        return json.dumps({"summary": f"{len(lines)} relations.", "key_insight": lines[0] if lines else "N/A", "risk_level": risk, "prediction": "N/A"}, ensure_ascii=False)


def generated(rows: DataFrame, system: Column, user: Column, backend: Backend, name: str = "answer") -> DataFrame:
    """rows with a backend's answers; an exception gives FAILED and not a failed task."""

    @F.pandas_udf("string")
    def answer(systems: pd.Series, users: pd.Series) -> pd.Series:
        def one(s: str, u: str) -> str:
            try:
                return backend.generate(s, u)
            except Exception:
                return FAILED

        return pd.Series([one(s, u) for s, u in zip(systems, users)])

    return rows.withColumn(name, answer(system, user))


def extract(batches: DataFrame, backend: Backend | None = None, text: str = "text_for_llm") -> DataFrame:
    """batch_index, entities, relations of each batch: the answer is cut out of fences and chatter, mended, and empty unless both keys are there. A backend with a method
    `extraction` gives both as they are, without a way through text."""
    backend = backend or RuleBackend()
    if hasattr(backend, "extraction"):

        @F.pandas_udf(EXTRACTION)
        def found(texts: pd.Series) -> pd.DataFrame:
            return pd.DataFrame([backend.extraction(t or "") for t in texts], columns=["entities", "relations"])

        return batches.select("batch_index", found(text).alias("e")).select("batch_index", "e.entities", "e.relations")
    answered = generated(batches.select("batch_index", text), F.lit(EXTRACTION_SYSTEM), F.col(text), backend)
    return answered.select("batch_index", extraction(F.col("answer")).alias("e")).select("batch_index", "e.entities", "e.relations")


def entities_of(extractions: DataFrame) -> DataFrame:
    return extractions.select("batch_index", F.posexplode("entities").alias("pos", "e")).select("batch_index", "pos", "e.name", "e.type")


def relations_of(extractions: DataFrame) -> DataFrame:
    """batch_index, seq (batch, place; a batch has fewer than 2^31 relations), source, target, relation, evidence, name."""
    rows = extractions.select("batch_index", F.posexplode("relations").alias("pos", "r"))
    return rows.select("batch_index", (F.col("batch_index").cast("long") * F.lit(1 << 31) + F.col("pos")).alias("seq"), "r.*")


def parsed_or_error(answer: Column, schema: str) -> Column:
    """struct(value, raw_analysis, error): the answer's JSON by a schema, or the answer itself with json_parse_failed."""
    body = fence_stripped(answer)
    good = F.try_parse_json(body).isNotNull()
    return F.struct(F.when(good, F.from_json(body, schema)).alias("value"), F.when(~good, answer).alias("raw_analysis"), F.when(~good, F.lit("json_parse_failed")).alias("error"))


__all__ = ["EXTRACTION", "Backend", "RuleBackend", "entities_of", "extract", "generated", "parsed_or_error", "relations_of"]
