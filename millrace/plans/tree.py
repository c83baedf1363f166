"""Normalising a tree of files: one header and uniform records per file, with a report.

    python -m millrace.plans.tree ROOT TARGET

A file is one row and is normalised where it is read, so nothing is shuffled.  Inputs are never
overwritten; files whose bytes already are what they should be are reported as ``skipped``.
"""

from __future__ import annotations

import re
import sys

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.deepjson import dumps
from ..operators.normalize import rule_fields
from ..operators.report import print_report
from ..sources import files
from ..sources.decoder import decode_values
from ..sources.staging import scope, stage

_IDENTIFY = re.compile(K.IDENTIFY_PATTERN, re.IGNORECASE)


def _category(instruction: object) -> str | None:
    m = _IDENTIFY.match(instruction) if isinstance(instruction, str) else None
    return m.group(1).strip() if m else None


def canonical(instruction: object) -> object:
    """As :func:`functions.text.canonical_instruction`, for one value."""
    c = _category(instruction)
    if c is None or instruction in (K.B2E, K.E2B):
        return instruction
    return f"Identify the {c}" if c.lower().startswith("balanda") else f"Identify the Balanda {c}"


def name_of(path: str) -> str:
    """As :func:`functions.text.grammar_name`, for one value."""
    stem = re.sub(r"(?s)(?<=.)\.[^.]*\Z", "", path.rsplit("/", 1)[-1])
    return re.sub(r"[\s\-]+", "_", re.sub(r"_v\d+$", "", stem)).lower()


_SHAPES = (
    (("instruction", "input", "output"), lambda o: (canonical(o["instruction"]), o["input"], o["output"])),
    (("instruction", "output"), lambda o: (canonical(o["instruction"]), "", o["output"])),
    (("balanda", "english"), lambda o: (K.B2E, o["balanda"], o["english"])),
)


def record(o: dict) -> dict | None:
    """As :func:`operators.normalize.normalize_record`, for one object; values keep their JSON type."""
    for keys, make in _SHAPES:
        if all(k in o for k in keys):
            return dict(zip(K.RECORD_KEYS, make(o)))
    if o.get("type") == "translation_pair" and "source" in o and "target" in o:
        return dict(zip(K.RECORD_KEYS, (K.B2E, o["source"], o["target"])))
    return None


def header(path: str, own: dict | None, metadata: dict | None, records: list[dict]) -> dict:
    """The header of a file: its own made uniform, else one from its metadata, else one from its records."""
    out = {"instruction_type": K.HEADER_TYPE, "grammar_name": name_of(path), "description": "", "rules": {}}
    if own is not None:
        rules = own.get("rules", {})
        named = {k: dict(zip(K.RULE_FIELDS, rule_fields(k, v))) for k, v in rules.items()} if isinstance(rules, dict) else {}
        return out | {"grammar_name": own.get("grammar_name") or out["grammar_name"], "description": own.get("description", ""), "rules": named}
    if metadata is not None:
        file_name = path.rsplit("/", 1)[-1]
        return out | {"grammar_name": re.sub(r"\s+", "_", str(metadata.get("dataset", out["grammar_name"]))).lower(), "description": metadata.get("description", K.METADATA_DESCRIPTION.format(file=file_name))}
    found = sorted({c for r in records if (c := _category(r.get("instruction", ""))) is not None})
    text = K.INFERRED_DESCRIPTION.format(name=out["grammar_name"].replace("_", " ")) + (K.INFERRED_ITEMS.format(items=", ".join(found)) if found else "")
    rules = {re.sub(r"\s+", "_", c.lower()): {"function": c, "structure": "", "notes": K.INFERRED_NOTE} for c in found}
    return out | {"description": text.strip(), "rules": rules}


def normalize_text(path: str, content: str | None) -> tuple[str, str, int, int]:
    """``(content, status, records before, records after)`` of one file."""
    own = metadata = None
    records: list[dict] = []
    for _, o, in_array in decode_values(content):
        if in_array:
            records.append(o)
        elif "instruction_type" in o or "grammar_name" in o:
            own = o if own is None else own
        elif o.get("type") == "metadata":
            metadata = o
        else:
            records.append(o)
    kept = [r for o in records if (r := record(o)) is not None]
    lines = [dumps(header(path, own, metadata, records), indent=2), *(dumps(r, separators=(",", ":")) for r in kept)]
    return "\n".join(lines) + "\n", "converted" if own is not None else "header-inferred", len(records), len(kept)


def normalized(source: DataFrame) -> DataFrame:
    """``(path, content)`` -> ``path, content, status, n_before, n_after``.

    A file that can't be normalised has its error as status, its content as it was and counts of 0; a
    file that is already uniform is ``skipped``.
    """
    schema = pa.schema([("path", pa.string()), ("content", pa.string()), ("status", pa.string()), ("n_before", pa.int32()), ("n_after", pa.int32())])

    def run(batches):
        for b in batches:
            out = []
            for path, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                try:
                    text, status, before, after = normalize_text(path, content)
                    text.encode("utf-8")
                    out.append((path, text, "skipped" if text == content else status, before, after))
                except Exception as e:  # noqa: BLE001 - one bad file must not stop the rest
                    out.append((path, content, f"ERROR: {e}", 0, 0))
            cols = list(zip(*out)) if out else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, schema.types)], schema=schema)

    return source.select("path", "content").mapInArrow(run, "path string, content string, status string, n_before int, n_after int")


def run(spark: SparkSession, root: str, target: str) -> DataFrame:
    """Normalise every ``*.jsonl`` below ``root`` into ``target``: ``path, status, n_before, n_after``."""
    done = stage(normalized(files.read_whole(spark, root, "*.jsonl")))
    written = stage(files.write_documents(done.where("NOT startswith(status, 'ERROR')"), target))
    state = written.select("path", F.col("status").alias("w"))
    return done.join(state, "path", "left").select("path", F.coalesce(F.when(F.col("w").startswith("ERROR") | (F.col("w") == "skipped"), F.col("w")), F.col("status")).alias("status"), "n_before", "n_after")


if __name__ == "__main__":
    session = SparkSession.builder.appName("tree").getOrCreate()
    with scope():
        print_report(run(session, sys.argv[1], sys.argv[2]).orderBy("path"), "path")
