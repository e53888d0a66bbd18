"""Model replies to records, and the slot in which a model runs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions.text import REPLY_NULL_WORDS, col, null_word
from folioforge.runtime import cut

PREDICATES = ("HAS_ATTRIBUTE", "IS_VARIANT_OF", "BELONGS_TO_CATEGORY", "HAS_MATERIAL")
SCHEMA = "products array<struct<name:string,model:string,sku:string,category:string,description:string>>, attributes array<struct<entity:string,key:string,value:string,unit:string,location:string>>, relations array<struct<subject:string,predicate:string,object:string>>"


def reply_json(raw: str | Column) -> Column:
    """The JSON object in a reply: without reasoning and fences, from the first brace to the last; null without one."""
    text = F.regexp_replace(F.regexp_replace(col(raw), r"(?s)<think>.*?</think>", ""), r"```(?:json)?\s*", "")
    found = F.regexp_extract(text, r"(?s)\{.*\}", 0)
    return F.when(found != "", found)


def repaired_json(json: str | Column) -> Column:
    """Without commas before a closing bracket, and with double quotes."""
    return F.regexp_replace(F.regexp_replace(col(json), r",\s*([}\]])", "$1"), r"(?<!\\)'", '"')


def parsed_reply(raw: str | Column) -> Column:
    """The reply as VARIANT, read as it is or else after repair; null if it is no object either way."""
    json = reply_json(raw)
    return F.coalesce(F.try_parse_json(json), F.try_parse_json(repaired_json(json)))


def reply_state(raw: str | Column) -> Column:
    json = reply_json(raw)
    return (
        F.when(json.isNull(), "no_object")
        .when(F.try_parse_json(json).isNotNull(), "parsed")
        .when(F.try_parse_json(repaired_json(json)).isNotNull(), "repaired")
        .otherwise("broken")
    )


def reply_count(raw: str | Column, member: str) -> Column:
    """A member of the reply as a number: an array's length, or the number it states."""
    v = parsed_reply(raw)
    return F.coalesce(F.try_variant_get(v, f"$.{member}", "bigint"), F.size(F.try_variant_get(v, f"$.{member}", "array<variant>")).cast("bigint"))


def reply_records(runs: DataFrame) -> dict[str, DataFrame]:
    """products, attributes and relations of the replies, each with doc_stem, chunk_id, run_id and its place in the reply.

    Items without their required parts are left out, null words become null, and a predicate that is not known is HAS_ATTRIBUTE."""
    typed = runs.withColumn("_r", F.from_json(F.coalesce(F.to_json(parsed_reply("raw_response")), F.lit("{}")), SCHEMA))
    base = ["doc_stem", "chunk_id", "run_id"]
    rows = {k: typed.select(*base, F.posexplode(f"_r.{k}").alias("place", "x")).select(*base, "place", "x.*") for k in ("products", "attributes", "relations")}
    tidy = lambda c: null_word(c, REPLY_NULL_WORDS).alias(c)
    p, a, r = rows["products"], rows["attributes"], rows["relations"]
    predicate = F.upper(F.trim("predicate"))
    return {
        "products": p.where("trim(name) <> ''").select(*base, "place", F.trim("name").alias("name"), *[tidy(c) for c in ("model", "sku", "category", "description")]),
        "attributes": a.where("trim(entity) <> '' and trim(key) <> '' and trim(value) <> ''").select(*base, "place", *[F.trim(c).alias(c) for c in ("entity", "key", "value")], tidy("unit"), tidy("location")),
        "relations": r.where("trim(subject) <> '' and trim(predicate) <> '' and trim(object) <> ''").select(*base, "place", F.trim("subject").alias("subject"), F.when(predicate.isin(*PREDICATES), predicate).otherwise(F.lit("HAS_ATTRIBUTE")).alias("predicate"), F.trim("object").alias("object")),
    }


Backend = Callable[[pd.Series], pd.Series]
#: Models by name: a function from contexts to replies, run on Arrow batches. 'none' replies with nothing to add.
BACKENDS: dict[str, Backend] = {"none": lambda contexts: pd.Series(['{"products": [], "attributes": [], "relations": []}'] * len(contexts), dtype=object)}


def run_backend(requests: DataFrame, backend: str | Backend = "none", attempt: int = 1) -> DataFrame:
    """Replies to requests: request_id, doc_stem, chunk_id, attempt, raw_response, backend_used. An unknown name is an error."""
    model = BACKENDS[backend] if isinstance(backend, str) else backend
    name = backend if isinstance(backend, str) else getattr(backend, "__name__", "own")

    def reply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in batches:
            yield f[["request_id", "doc_stem", "chunk_id"]].assign(attempt=attempt, raw_response=model(f["context"]).to_numpy(), backend_used=name)

    return requests.select("request_id", "doc_stem", "chunk_id", "context").mapInPandas(reply, "request_id string, doc_stem string, chunk_id string, attempt int, raw_response string, backend_used string")


def run_with_retries(requests: DataFrame, backend: str | Backend, retries: int = 0) -> DataFrame:
    """All attempts; only requests whose last reply could not be read are tried again."""
    done = last = cut(run_backend(requests, backend), "replies")
    for n in range(2, retries + 2):
        bad = last.where(~reply_state("raw_response").isin("parsed", "repaired")).select("request_id")
        if bad.isEmpty():
            break
        last = cut(run_backend(requests.join(bad, "request_id", "left_semi"), backend, n), "replies")
        done = done.unionByName(last)
    return done
