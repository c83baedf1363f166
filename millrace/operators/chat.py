"""Chat prompts from records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.text import direction, strip
from .ranking import id_bucket, positions


def user_content(instruction: str = "instruction", inp: str = "input") -> Column:
    """The instruction, and after an empty line the input where there is one; NULL instruction counts as empty."""
    i = F.coalesce(instruction, F.lit(""))
    return F.when(F.length(F.coalesce(inp, F.lit(""))) > 0, F.concat(i, F.lit("\n\n"), F.col(inp))).otherwise(i)


def messages(with_answer: bool = True, system: str = K.SYSTEM_PROMPT) -> Column:
    """``array<struct<role,content>>``: system, user and, if asked for, assistant."""
    turns = [("system", F.lit(system)), ("user", user_content())] + ([("assistant", F.coalesce("output", F.lit("")))] if with_answer else [])
    return F.array(*[F.struct(F.lit(r).alias("role"), c.alias("content")) for r, c in turns])


def render(chat: Column, generation_prompt: bool = False) -> Column:
    """A chat in the ChatML layout; ``generation_prompt`` opens the assistant's turn."""
    body = F.array_join(F.transform(chat, lambda m: F.concat(F.lit("<|im_start|>"), m["role"], F.lit("\n"), m["content"], F.lit("<|im_end|>\n"))), "")
    return F.concat(body, F.lit("<|im_start|>assistant\n")) if generation_prompt else body


def eval_pairs(df: DataFrame, key: str = "rec_id") -> DataFrame:
    """Translation records only: ``key, direction, prompt, reference``, the reference stripped, the prompt without answer."""
    d = df.where(F.col("instruction").isin(K.B2E, K.E2B))
    return d.select(key, direction("instruction").alias("direction"), render(messages(False), True).alias("prompt"), strip(F.coalesce("output", F.lit(""))).alias("reference"))


def batch_slices(df: DataFrame, key: str, group: list[str], size: int = 8) -> DataFrame:
    """``df`` with ``batch_no`` (from 0): ``size`` rows each, in the order of the unique integer ``key`` within ``group``."""
    p = positions(df, group, id_bucket(F.col(key)), [F.col(key)], "__k", "__n")
    return p.withColumn("batch_no", F.floor((F.col("__k") - 1) / size).cast("bigint")).drop("__k", "__n")
