"""The queries of this sub-package and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.staging import stage
from ..sources.tables import table
from . import defects, encode, formatting, langid, mojibake, overlap, packing, skeleton
from .sql import SQL  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f):
    """Register a query under its own name."""
    QUERIES[f.__name__] = f
    return f


def _records(spark, d):
    fields = ["rec_id", "instruction", "input", "output"]
    raw = stage(formatting.parsed(table(spark, d, "train_raw")))  # records are read twice: lines are parsed once
    return table(spark, d, "train").select(*fields).unionByName(raw)


@query
def p1_found(spark, d):
    """Each copy beyond the smallest rec_id of its group."""
    return formatting.copies(_records(spark, d))


@query
def p1_groups(spark, d):
    """Each record that is left, with its number of copies."""
    return formatting.groups(_records(spark, d))


@query
def p6_found(spark, d):
    """Inputs and outputs that hold characters which only look like the usual ones."""
    return skeleton.found(table(spark, d, "train"), "rec_id", ["input", "output"])


@query
def p6_clean(spark, d):
    """Those texts in their consistent form."""
    return skeleton.cleaned(table(spark, d, "train"), "rec_id", ["input", "output"])


@query
def p6_groups(spark, d):
    """Skeletons that several different texts share."""
    return skeleton.groups(table(spark, d, "train"), "rec_id", ["input", "output"])


@query
def p8_ids(spark, d):
    """Token ids of each document."""
    return encode.encode(table(spark, d, "documents"))


@query
def p8_decoded(spark, d):
    """The texts that the ids stand for: an exact round trip."""
    return encode.decode(encode.encode(table(spark, d, "documents")))


def _items(spark, d):
    return stage(packing.pieces(encode.token_counts(table(spark, d, "documents"))))  # read twice: histogram, assignment


@query
def p9_containers(spark, d):
    """Documents in containers of 2,048 tokens."""
    return packing.containers(_items(spark, d))


@query
def p9_buckets(spark, d):
    """Documents in batches of optimal length buckets."""
    return packing.bucket_batches(_items(spark, d))


@query
def p9_unused(spark, d):
    """What the containers leave unused."""
    return packing.unused(packing.containers(_items(spark, d)))


@query
def p10_found(spark, d):
    """Documents with wrongly decoded characters."""
    return mojibake.found(table(spark, d, "documents"))


@query
def p10_restored(spark, d):
    """Those documents with their original text where it can be restored."""
    return mojibake.restored(table(spark, d, "documents"))


def _samples(spark, d):
    return langid.load_samples(table(spark, d, "lang_samples"))


_LABELLED = {"input": "input_lang", "output": "output_lang"}


@query
def p4_found(spark, d):
    """Texts of one language with a missing or wrong label, and every run of texts of several languages."""
    return langid.segments(table(spark, d, "train"), "rec_id", _LABELLED, _samples(spark, d), cases_only=True).select("rec_id", "field_name", "seg_no", "lang")


@query
def p4_segments(spark, d):
    """The language of every text that has words, run by run, with a confidence."""
    return langid.segments(table(spark, d, "train"), "rec_id", _LABELLED, _samples(spark, d), least=1)


@query
def p3_found(spark, d):
    """Each defective pair with the first of its defects."""
    return defects.found(table(spark, d, "train"), _samples(spark, d))


@query
def p3_defects(spark, d):
    """Every defect of each pair."""
    return defects.defects(table(spark, d, "train"), _samples(spark, d))


@query
def p5_found(spark, d):
    """Training records and evaluation inputs that are the same or nearly so."""
    return overlap.overlaps(table(spark, d, "train"), table(spark, d, "test"))


def _linked(spark, d):
    return overlap.linked(table(spark, d, "train"), table(spark, d, "test"), train_label="_source", test_label="split_name")


@query
def p5_classes(spark, d):
    """Every row with an overlap, with the class of its text and the number of classes that is linked to."""
    return overlap.classes(_linked(spark, d))


@query
def p5_links(spark, d):
    """The pairs of classes that overlap."""
    return overlap.class_links(_linked(spark, d))


@query
def p5_report(spark, d):
    """How many of them there are for each split and source."""
    return overlap.report(_linked(spark, d))
