"""Recognition, judging and language providers: pluggable, with deterministic offline defaults.

A provider is a factory that makes a client on each partition; the client maps one
record to one result. Errors become rows with an ``error`` column, not failed tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RESULT = "latex string, confidence double, error string"
_registry: dict[str, Callable[[], Callable[[dict], dict]]] = {}


def register(name: str, factory: Callable[[], Callable[[dict], dict]]) -> None:
    _registry[name] = factory


def resolve(name: str) -> Callable[[], Callable[[dict], dict]]:
    if name not in _registry:
        raise KeyError(f"no provider {name}; there are {sorted(_registry)}")
    return _registry[name]


def recognise(df: DataFrame, name: str) -> DataFrame:
    """``df`` with latex, confidence and error of a provider; one client a partition, closed when it ends."""
    factory, schema = resolve(name), df.schema.simpleString()[len("struct<") : -1]
    columns = df.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = factory()
        try:
            for batch in batches:
                made = []
                for row in batch.to_dict("records"):
                    try:
                        made.append({"latex": None, "confidence": 0.0, "error": None} | client(row))
                    except Exception as e:  # the boundary to code of providers
                        made.append({"latex": None, "confidence": 0.0, "error": f"{type(e).__name__}: {e}"})
                out = pd.DataFrame(made, columns=["latex", "confidence", "error"], index=batch.index)
                yield pd.concat([batch[[c for c in columns if c not in out]], out], axis=1)[[*[c for c in columns if c not in out], *out]]
        finally:
            getattr(client, "close", lambda: None)()

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name not in ("latex", "confidence", "error"))
    assert schema is not None
    return df.mapInPandas(run, f"{kept}, {RESULT}")


def passthrough(text: Column) -> list[Column]:
    """The default recogniser, native: the text itself at .2, nothing at 0."""
    t = F.nullif(F.trim(text), F.lit(""))
    return [t.alias("latex"), F.when(t.isNull(), 0.0).otherwise(0.2).alias("confidence")]


register("plain_text", lambda: lambda row: {"latex": (row.get("text") or "").strip() or None, "confidence": 0.2 if (row.get("text") or "").strip() else 0.0})

#: Function words by language: fixed lists of the offline language provider.
STOP_WORDS = {
    "en": "the of and to in is that it for with was are this be",
    "fr": "le la les de des et est une pour dans que qui sur pas",
    "de": "der die das und ist ein eine nicht mit den von zu auf für",
    "es": "el los las y del en una por con para no su como más",
}


def language(text: Column, least: float = 0.2) -> Column:
    """struct<language, confidence>: the language with the largest share of function words; und below ``least``."""
    counts = [F.regexp_count(F.lower(text), F.lit(rf"(?U)\b(?:{'|'.join(words.split())})\b")).cast("double") for words in STOP_WORDS.values()]
    total = F.greatest(sum(counts[1:], counts[0]), F.lit(1.0))
    ranked = F.sort_array(F.array(*[F.struct((-c / total).alias("s"), F.lit(k).alias("l")) for k, c in zip(STOP_WORDS, counts)]))
    best = ranked[0]
    return F.struct(F.when(-best["s"] >= least, best["l"]).otherwise("und").alias("language"), (-best["s"]).alias("confidence"))


def judge_unavailable() -> list[Column]:
    """The default judge: not there, so it accepts at one half."""
    return [F.lit(True).alias("accepted"), F.lit(0.5).alias("score"), F.lit("judge unavailable").alias("reason")]
