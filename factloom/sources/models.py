"""Calls of a model port: a bounded number of tries per prompt, each rejected answer quoted in the next; usage is summed."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factloom.sources.files import LanguageModelPort

TRIES, CALLS_PER_DOCUMENT, MAX_TOKENS = 3, 500, 16_000


def untrusted(text: str) -> str:
    """A document's text marked as data."""
    return f"<source>\n{text}\n</source>"


def language_model(settings: dict[str, Any], providers: dict[str, Callable[[dict[str, Any]], LanguageModelPort]]) -> LanguageModelPort | None:
    """The model that ``settings["provider"]`` names, made by its provider; none or "none": the run stays deterministic."""
    name = settings.get("provider") or "none"
    if name == "none":
        return None
    if name not in providers:
        raise ValueError(f"no provider {name!r}; there are {', '.join(sorted(providers)) or 'none'}")
    return providers[name](settings)


def ask(port: LanguageModelPort, system: str, user: str, schema: dict[str, Any], accept: Callable[[dict], Any] | None = None, tries: int = TRIES, max_tokens: int = MAX_TOKENS) -> tuple[Any, list[str], int]:
    """(answer or None, why answers were rejected, calls). ``accept`` turns a payload into the answer, or raises."""
    rejected: list[str] = []
    for call in range(1, tries + 1):
        again = f"\n\nNot accepted ({rejected[-1]}). Answer again, within the schema." if rejected else ""
        try:
            payload = port.complete_json(system=system, user=user + again, schema=schema, max_tokens=max_tokens)
            return (accept(payload) if accept else payload), rejected, call
        except ConnectionError as e:  # the provider is out of reach: asking again at once is no use
            return None, [*rejected, str(e)], call
        except Exception as e:  # noqa: BLE001 - whatever is wrong with an answer is quoted, not repaired
            rejected.append(f"{type(e).__name__}: {e}")
    return None, rejected, tries


def answers(prompts: DataFrame, port: LanguageModelPort, system: str, tries: int = TRIES, per_document: int = CALLS_PER_DOCUMENT) -> DataFrame:
    """(document_id, record_index, json, rejected, calls) from (document_id, record_index, prompt, schema as JSON).

    A document's budget is shared out among its prompts, so no task has to know what another one used: each prompt gets
    ``tries`` calls, those that the budget cannot pay for get none and say so.
    """
    paid = F.row_number().over(Window.partitionBy("document_id").orderBy("record_index")) * tries <= per_document
    ready = prompts.select("document_id", "record_index", "prompt", "schema", paid.alias("paid"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for r in b.itertuples(index=False):
                got, why, calls = ask(port, system, untrusted(r.prompt), json.loads(r.schema), tries=tries) if r.paid else (None, ["the document's budget of calls is used up"], 0)
                rows.append((r.document_id, r.record_index, None if got is None else json.dumps(got, ensure_ascii=False), "; ".join(why), calls))
            yield pd.DataFrame(rows, columns=["document_id", "record_index", "json", "rejected", "calls"])

    return ready.mapInPandas(run, f"document_id string, record_index {prompts.schema['record_index'].dataType.simpleString()}, json string, rejected string, calls long")


def usage(answered: DataFrame) -> DataFrame:
    """Per document: calls, answers and prompts without one."""
    return answered.groupBy("document_id").agg(F.sum("calls").alias("calls"), F.count("json").alias("answered"), F.count_if(F.col("json").isNull()).alias("unanswered"))
