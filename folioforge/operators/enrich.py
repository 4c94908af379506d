"""Enrichment by a pluggable function with a cache: only what the cache lacks is asked, in batches, with retries."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import stable_key


def request_key(provider: str, model: Column, prompt: str, text: Column) -> Column:
    return stable_key(F.lit(provider), model, F.lit(prompt), text)


def enriched(asks: DataFrame, cache: DataFrame, fn: Callable[[list[str]], list[str]], tries: int = 5, wait: float = 0.0, batch: int = 64) -> tuple[DataFrame, DataFrame]:
    """(all asks with response and error, new cache rows). asks: key, text and any others; cache: key, response.

    Equal keys are asked once. fn maps texts to responses; a batch that fails is tried again, then one by one, and a text that still fails
    has its error in place of a response and does not enter the cache.
    """
    todo = asks.select("key", "text").dropDuplicates(["key"]).join(cache, "key", "left_anti")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def attempt(texts: list[str]) -> list[str]:
            for k in range(tries):
                try:
                    return fn(texts)
                except Exception:
                    if k + 1 == tries:
                        raise
                    time.sleep(wait * 2**k)
            return []

        for rows in batches:
            for at in range(0, len(rows), batch):
                part = rows.slice(at, batch)
                texts = part.column(part.schema.get_field_index("text")).to_pylist()
                try:
                    got, errors = attempt(texts), [None] * len(texts)
                except Exception:
                    got, errors = [], []
                    for t in texts:
                        try:
                            got += attempt([t])
                            errors.append(None)
                        except Exception as e:
                            got.append(None)
                            errors.append(str(e)[:200])
                yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index("key")), pa.array(got, pa.string()), pa.array(errors, pa.string())], names=["key", "response", "error"])

    fresh = todo.mapInArrow(run, "key string, response string, error string")
    known = cache.select("key", "response", F.lit(None).cast("string").alias("error")).unionByName(fresh)
    return asks.join(known, "key", "left"), fresh.where("error IS NULL").select("key", "response")


EXTRACTION = """places array<struct<name string, variant_names array<string>, feature_term string, aat_type_id string, country string, country_code string, admin_hierarchy array<string>,
 spatial_relations array<struct<reference string, bearing string, distance_value double, distance_unit string>>, latitude double, longitude double, population array<struct<year int, count bigint>>, area string,
 peoples array<struct<name string, relation string>>, notes array<string>>>"""


def places_of(responses: DataFrame, types: list[str], key: str = "entry_id", response: str = "response") -> DataFrame:
    """key, place_no (from 1) and the typed place of each valid response; a type outside the closed list makes a response invalid,
    'other' becomes null, and a lone latitude is no coordinate."""
    parsed = responses.select(key, F.from_json(response, EXTRACTION, {"mode": "PERMISSIVE"}).alias("r")).where("r.places IS NOT NULL")
    allowed = F.array(*map(F.lit, [*types, "other"]))
    valid = parsed.where(F.forall("r.places", lambda p: p["aat_type_id"].isNull() | F.array_contains(allowed, p["aat_type_id"])))
    at = valid.select(key, F.posexplode("r.places").alias("place_no", "place"))
    both = F.col("place.latitude").isNotNull() & F.col("place.longitude").isNotNull()
    place = F.col("place").withField("aat_type_id", F.nullif(F.col("place.aat_type_id"), F.lit("other")))
    place = place.withField("latitude", F.when(both, F.col("place.latitude"))).withField("longitude", F.when(both, F.col("place.longitude")))
    return at.select(key, (F.col("place_no") + 1).alias("place_no"), place.alias("place"))


def salvage_field(text: Column, field: str) -> Column:
    """A string or number field of JSON that may be cut short."""
    return F.coalesce(F.get_json_object(text, f"$.{field}"), F.nullif(F.regexp_extract(text, rf'"{field}"\s*:\s*"?([^",}}\]]*)', 1), F.lit("")))
