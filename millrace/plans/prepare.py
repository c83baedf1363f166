"""From a tree of loosely structured files to validated splits.

    python -m millrace.plans.prepare ROOT --out-dir OUT [--seed 42] [--no-augment-from-rules]

One lazy plan up to the split (scan, decode, classify, augment, keep-first, stratified split); it is
staged once and then written, validated and summarised.
"""

from __future__ import annotations

import argparse
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.text import instruction_type
from ..operators import augment, classify, dedup, report, split, validate
from ..sources import decoder, files
from ..sources.staging import scope, stage


@dataclass
class Prepared:
    """What a run leaves: the split records and the reports."""

    records: DataFrame
    source_counts: DataFrame
    dedup_stats: DataFrame
    summary: DataFrame
    by_type: DataFrame
    failures: DataFrame
    valid: dict[str, int]


def load(spark: SparkSession, root: str, augment_rules: bool = True) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """``(files, primary, all records, failures)``; a file without records is still among the files, and what of a
    file could not be decoded is among the failures ``path, error``."""
    source = files.read_whole(spark, root)
    decoded = stage(decoder.parse_files(source))
    objects = decoded.where("error IS NULL")
    kind = classify.kind(F.col("obj"))
    primary = objects.where(kind == "record").select(
        F.col("path").alias("_source"), F.col("ordinal").cast("bigint").alias("ordinal"), *[F.get_json_object("obj", f"$.{k}").alias(k) for k in K.RECORD_KEYS]
    ).withColumn("_itype", instruction_type("instruction"))
    headers = classify.first_header(objects, [F.col("ordinal")])
    everything = augment.union_augmented(primary, augment.augment_rules(headers, "path", "obj"), augment_rules)
    deep = objects.where(kind == "invalid").select("path", F.concat(F.lit("ERROR: object "), F.col("ordinal").cast("string"), F.lit(" is nested deeper than Spark's JSON functions read")).alias("error"))
    return source.select("path"), primary, everything, decoded.where("error IS NOT NULL").select("path", "error").unionAll(deep)


def run(spark: SparkSession, root: str, out_dir: str | None = None, seed: int = 42, augment_rules: bool = True) -> Prepared:
    """Prepare ``root``; with ``out_dir``, write and validate ``train.jsonl``, ``val.jsonl`` and ``test.jsonl`` there.

    A tree without matching files raises :class:`sources.files.NoInput`; files without records give
    empty splits.
    """
    paths, primary, everything, failures = load(spark, root, augment_rules)
    order = [F.col("_source"), F.col("phase"), F.col("ordinal")]
    kept = dedup.keep_first(everything, order).withColumn("rid", F.concat_ws(":", "_source", F.col("phase").cast("string"), F.col("ordinal").cast("string")))
    # Ranking reads its input twice (rows, bucket sizes), so what it ranks is staged.
    labelled = stage(split.stratified_split(stage(kept), ["_source", "_itype"], "rid", seed))
    done = stage(split.seeded_shuffle(labelled, "rid", ["split"], seed))
    valid: dict[str, int] = {}
    if out_dir:
        files.write_splits(done, out_dir)
        for name in K.SPLITS:
            valid[name] = validate.require_valid(spark, f"{out_dir}/{name}.jsonl")
    return Prepared(
        done,
        report.source_counts(paths.withColumnRenamed("path", "file_path"), primary),
        dedup.dedup_stats(everything),
        report.split_summary(done),
        report.itype_by_split(done, F.col("_itype")),
        failures,
        valid,
    )


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("root")
    p.add_argument("--out-dir", required=True)
    p.add_argument("--seed", type=int, default=42)
    p.add_argument("--augment-from-rules", action=argparse.BooleanOptionalAction, default=True)
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("prepare").getOrCreate()
    with scope():
        done = run(spark, a.root, a.out_dir, a.seed, a.augment_from_rules)
        for df, label in ((done.source_counts.orderBy("file_path"), "file_path"), (done.summary, "split"), (done.by_type.orderBy("itype"), "itype"), (done.failures.orderBy("path"), "path")):
            report.print_report(df, label)
        print(done.dedup_stats.first())


if __name__ == "__main__":
    main()
