"""Stage runner: each stage writes a table, a manifest says what was written, runs can skip and resume.

A stage reads the outputs of earlier stages (and files of its own) and writes one table into a new
folder under the run's root. When the table is complete, a row is appended to the manifest: the
stage, a fingerprint of everything it was made from, the folder and its schema. A folder without a
manifest row is the rest of a failed attempt and is never read.

A run does the stages in order. A skipped stage is not run and its last stored output is used,
whatever it was made from. A stage whose last output has the fingerprint of this run is reused,
so a run that failed goes on where it stopped. Any other stage is built. All reads and writes go
through Spark's sources, so the root may lie in any store that the cluster shares.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkwell.session import release

MANIFEST = "seq bigint, stage string, fingerprint string, path string, schema string, finished timestamp"


class MissingStage(RuntimeError):
    """A skipped stage has no stored output, but a stage that is to run reads it."""


class StageFailed(RuntimeError):
    """A stage failed; the outputs of the stages before it are stored."""

    def __init__(self, stage: str, cause: BaseException) -> None:
        super().__init__(f"stage {stage} failed: {type(cause).__name__}: {cause}")
        self.stage = stage


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.parquet(path)


@dataclass(frozen=True)
class Stage:
    """``build`` takes the outputs of ``reads`` in that order; ``files`` and ``params`` count in the fingerprint."""

    name: str
    build: Callable[..., DataFrame]
    reads: tuple[str, ...] = ()
    files: tuple[str, ...] = ()
    params: dict = field(default_factory=dict)
    write: Callable[[DataFrame, str], None] = write_parquet


@dataclass(frozen=True)
class Outcome:
    """What a run did with a stage: ``action`` is built, reused or skipped; ``path`` is None where nothing is stored."""

    stage: str
    action: str
    path: str | None


def file_fingerprint(spark: SparkSession, paths: Sequence[str]) -> int:
    """One number for the files under ``paths`` as listed: names, lengths and times; no file is opened."""
    if not paths:
        return 0
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    return files.agg(F.coalesce(F.bit_xor(F.xxhash64("path", "length", "modificationTime")), F.lit(0))).first()[0]


class Runner:
    """Runs ``stages`` (in order, each reading earlier ones only) with their outputs under ``root``.

    ``groups``: names that stand for several stages in ``skip``.
    """

    def __init__(self, spark: SparkSession, root: str, stages: Sequence[Stage], groups: dict[str, Iterable[str]] | None = None) -> None:
        self.spark, self.root, self.stages = spark, root.rstrip("/"), list(stages)
        self.groups = {k: tuple(v) for k, v in (groups or {}).items()}
        seen: set[str] = set()
        for s in self.stages:
            if s.name in seen or not set(s.reads) <= seen:
                raise ValueError(f"stage {s.name} is there twice or reads a stage that is not before it")
            seen.add(s.name)

    def manifest(self) -> DataFrame:
        """All complete outputs, one row each; empty before the first."""
        try:
            return self.spark.read.schema(MANIFEST).json(f"{self.root}/_manifest")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], MANIFEST)

    def last(self) -> dict[str, dict]:
        """The last complete output of every stage that has one; at most one row for each stage."""
        newest = self.manifest().groupBy("stage").agg(
            F.max_by(F.struct("fingerprint", "path", "schema"), F.struct("seq", "finished")).alias("x"))
        return {r["stage"]: r["x"].asDict() for r in newest.collect()}

    def output(self, stage: str, stored: dict[str, dict] | None = None) -> DataFrame:
        """The last complete output of a stage, with the schema that it was written with."""
        row = (stored or self.last()).get(stage)
        if row is None:
            raise MissingStage(f"stage {stage} has no stored output under {self.root}")
        return self.spark.read.schema(T.StructType.fromJson(json.loads(row["schema"]))).format(_format(row["path"])).load(row["path"])

    def _skipped(self, skip: Iterable[str]) -> set[str]:
        names = {s.name for s in self.stages}
        out: set[str] = set()
        for name in skip:
            members = self.groups.get(name, (name,))
            if not set(members) <= names:
                raise ValueError(f"no stage {name}; there are {sorted(names | set(self.groups))}")
            out |= set(members)
        return out

    def _fingerprint(self, stage: Stage, stored: dict[str, dict]) -> str:
        made_of = [stage.name, stage.params, file_fingerprint(self.spark, stage.files),
                   [(r, stored[r]["fingerprint"], stored[r]["path"]) for r in stage.reads]]
        return hashlib.sha256(json.dumps(made_of, sort_keys=True, default=str).encode()).hexdigest()

    def _record(self, stage: Stage, fingerprint: str, path: str, schema: str) -> dict:
        seq = (self.manifest().agg(F.max("seq")).first()[0] or 0) + 1
        row = self.spark.createDataFrame([(seq, stage.name, fingerprint, path, schema)], "seq bigint, stage string, fingerprint string, path string, schema string")
        row.withColumn("finished", F.current_timestamp()).coalesce(1).write.mode("append").json(f"{self.root}/_manifest")
        return {"fingerprint": fingerprint, "path": path, "schema": schema}

    def run(self, skip: Iterable[str] = (), resume: bool = True) -> list[Outcome]:
        """Do the stages; what cannot work is refused before any stage is run.

        Without ``resume`` every stage that is not skipped is built again. A failing stage ends the
        run with StageFailed.
        """
        skipped, stored, done = self._skipped(skip), self.last(), []
        for s in self.stages:
            gone = [r for r in s.reads if r in skipped and r not in stored]
            if s.name not in skipped and gone:
                raise MissingStage(f"stage {s.name} reads {', '.join(gone)}: skipped, and nothing is stored under {self.root}")
        for s in self.stages:
            if s.name in skipped:
                done.append(Outcome(s.name, "skipped", stored.get(s.name, {}).get("path")))
                continue
            try:
                fingerprint = self._fingerprint(s, stored)
                if resume and stored.get(s.name, {}).get("fingerprint") == fingerprint:
                    done.append(Outcome(s.name, "reused", stored[s.name]["path"]))
                    continue
                df = s.build(*[self.output(r, stored) for r in s.reads])
                path = f"{self.root}/{s.name}/{uuid.uuid4().hex}.{'json' if s.write is not write_parquet else 'parquet'}"
                s.write(df, path)
                schema, df = df.schema.json(), None
                stored[s.name] = self._record(s, fingerprint, path, schema)
                release(self.spark)     # a stage's shuffles do not stay on the disks while the later ones run
            except Exception as e:
                raise StageFailed(s.name, e) from e
            done.append(Outcome(s.name, "built", path))
        return done


def _format(path: str) -> str:
    return path.rsplit(".", 1)[-1]
