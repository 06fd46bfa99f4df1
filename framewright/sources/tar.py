"""Tar shards as a data source, array payloads, and the shard writer."""

from __future__ import annotations

import io
import json
import os
import re
import tarfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from framewright.functions.text import SAMPLE_FIELDS

MEMBERS = "shard string, pos bigint, name string, offset bigint, size bigint, data binary"
SAMPLES = "shard string, pos bigint, key string, image binary, lowdim binary, mano binary, depth binary, meta binary"


def list_shards(path: str) -> list[str]:
    """Tar files below a folder (or the one file), sorted by path."""
    if os.path.isfile(path):
        return [path]
    return sorted(os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".tar"))


class _Shard(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


def tar_members(path: str, payload: bool) -> Iterator[tuple]:
    """Regular members in order; ``offset`` is where a member's bytes begin in the file."""
    with tarfile.open(path, "r:") as t:
        for i, m in enumerate(x for x in t if x.isfile()):
            yield path, i, m.name, m.offset_data, m.size, t.extractfile(m).read() if payload else None


def tar_samples(path: str, fields: set[str]) -> Iterator[tuple]:
    """Samples: neighbouring members of one key. Only the payloads of ``fields`` are read; a member of no known field is an error."""
    alt = {s: f for f, s in SAMPLE_FIELDS.items()}
    pat = re.compile(r"^(.*)\.(" + "|".join(map(re.escape, alt)) + r")$")
    order = list(SAMPLE_FIELDS)
    key, row, pos = None, {}, 0
    with tarfile.open(path, "r:") as t:
        for m in t:
            if not m.isfile():
                continue
            g = pat.match(os.path.basename(m.name))
            if not g:
                raise ValueError(f"{path}: {m.name} is no member of a sample")
            if g[1] != key:
                if key is not None:
                    yield (path, pos, key, *[row.get(f) for f in order])
                    pos += 1
                key, row = g[1], {}
            f = alt[g[2]]
            row[f] = t.extractfile(m).read() if f in fields else b""
    if key is not None:
        yield (path, pos, key, *[row.get(f) for f in order])


class TarReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.names = schema.fieldNames()
        self.paths = list_shards(options["path"])
        a, z = int(options.get("start", 0)), int(options.get("end", len(self.paths)))
        if a < 0 or z < a or a > len(self.paths):
            raise ValueError(f"bad shard range [{a}, {z}) of {len(self.paths)}")
        self.paths = self.paths[a:z]
        self.samples = options.get("samples", "true") == "true"

    def partitions(self) -> list[InputPartition]:
        return [_Shard(p) for p in self.paths]

    def read(self, partition: _Shard) -> Iterator[tuple]:
        if partition is None:
            return
        full = [x.split()[0] for x in (SAMPLES if self.samples else MEMBERS).split(", ")]
        at = [full.index(n) for n in self.names]
        rows = tar_samples(partition.path, {n for n in self.names if n in SAMPLE_FIELDS}) if self.samples else tar_members(partition.path, "data" in self.names)
        for r in rows:
            yield tuple(r[i] for i in at)


class TarSource(DataSource):
    """``format("frametar")``: one partition per tar file, samples or (``samples`` = false) single members.

    Options ``path`` and ``start``/``end`` (a range of the sorted files). A schema with fewer columns reads fewer payloads: headers only if it
    names no payload; a payload that isn't asked for comes as an empty value where it is present.
    """

    @classmethod
    def name(cls) -> str:
        return "frametar"

    def schema(self) -> str:
        return SAMPLES if self.options.get("samples", "true") == "true" else MEMBERS

    def reader(self, schema: StructType) -> DataSourceReader:
        return TarReader(schema, dict(self.options))


def read_samples(spark: SparkSession, path: str, columns: list[str] | None = None, start: int = 0, end: int | None = None) -> DataFrame:
    """Samples of tar shards. ``columns`` restricts which payloads are read (``shard, pos, key, meta`` is a header scan)."""
    spark.dataSource.register(TarSource)
    r = spark.read.format("frametar").option("path", path).option("start", start)
    r = r if end is None else r.option("end", end)
    if columns:
        kinds = dict(x.split() for x in SAMPLES.split(", "))
        r = r.schema(", ".join(f"{c} {kinds[c]}" for c in columns))
    return r.load()


def read_members(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    spark.dataSource.register(TarSource)
    r = spark.read.format("frametar").option("path", path).option("samples", "false")
    return (r if payload else r.schema(", ".join(x for x in MEMBERS.split(", ") if not x.startswith("data")))).load()


def frame_bytes(frames: DataFrame, path: str = "shard_path", offset: str = "offset", size: str = "size", name: str = "name") -> DataFrame:
    """``data`` of each frame: by offset in its tar, by member name without offset, or the whole file if it is no tar.

    Rows of one file are read by one task in file order; a short read is an error.
    """
    cols, kinds = frames.columns, dict(frames.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            out = []
            fh, at, tar = None, None, None
            for f, o, n, m in zip(p[path], p[offset], p[size], p[name]):
                if f != at:
                    for x in (fh, tar):
                        if x:
                            x.close()
                    fh, at, tar = open(f, "rb"), f, None
                if not pd.isna(o):
                    fh.seek(int(o))
                    b = fh.read(int(n))
                    if len(b) != int(n):
                        raise ValueError(f"{f}: {len(b)} of {int(n)} bytes at {int(o)}")
                elif f.endswith(".tar"):
                    tar = tar or tarfile.open(f, "r:")
                    b = tar.extractfile(m).read()
                else:
                    fh.seek(0)
                    b = fh.read()
                out.append(b)
            for x in (fh, tar):
                if x:
                    x.close()
            yield p.assign(data=out)

    near = frames.repartition(path).sortWithinPartitions(path, offset)
    return near.mapInPandas(run, ", ".join(f"`{c}` {kinds[c]}" for c in cols) + ", data binary")


def encode_npy(a: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.save(out, np.ascontiguousarray(a), allow_pickle=False)
    return out.getvalue()


def decode_npy(b: bytes) -> np.ndarray:
    return np.load(io.BytesIO(b), allow_pickle=False)


def npy_to_array(data: Column) -> Column:
    """Flat numbers of npy payloads; null for null, empty or unreadable bytes."""

    def one(b):
        try:
            return None if b is None or not len(b) else np.load(io.BytesIO(bytes(b)), allow_pickle=False).astype(np.float64).ravel()
        except Exception:
            return None

    def many(s: pd.Series) -> pd.Series:
        return s.map(one)

    many.__annotations__ = {"s": pd.Series, "return": pd.Series}
    return F.pandas_udf(many, "array<double>")(data)


def array_to_npy(numbers: Column) -> Column:
    """float32 npy payloads of number arrays."""

    def one(a):
        if a is None:
            return None
        out = io.BytesIO()
        np.save(out, np.asarray(a, np.float32), allow_pickle=False)
        return out.getvalue()

    def many(s: pd.Series) -> pd.Series:
        return s.map(one)

    many.__annotations__ = {"s": pd.Series, "return": pd.Series}
    return F.pandas_udf(many, "binary")(numbers)


def decoded_lowdim(data: Column, size: int = 116) -> Column:
    """Frame vector of an npy payload; null unless it has ``size`` numbers."""
    a = npy_to_array(data)
    return F.when(F.size(a) == size, a)


def parsed_meta(data: Column, schema: str) -> Column:
    """Meta struct of JSON bytes; null if it is missing or unreadable."""
    t = data.cast("string")
    return F.when(F.schema_of_variant(F.try_parse_json(t)).startswith("OBJECT"), F.from_json(t, schema))


def meta_bytes(meta: Column) -> Column:
    """JSON of a meta struct, nulls kept."""
    return F.to_json(meta, {"ignoreNullFields": "false"}).cast("binary")


def write_shards(samples: DataFrame, folder: str, shard: str = "shard_idx", clip: str = "clip_id", order: tuple = ("episode_index", "frame_idx")) -> DataFrame:
    """Write ``key, image, lowdim, mano, depth, meta`` (bytes) to ``shard-%06d.tar``; one row per shard with what was written.

    A shard is one task's work, written under another name and then renamed, so a lost or repeated task leaves no half file. Clips are whole or
    absent: a clip with a frame that lacks image, lowdim, mano or meta is skipped. Members of a sample come in fixed order. ``folder`` must
    be shared by the executors.
    """
    need = ["image", "lowdim", "mano", "meta"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tar = tmp = cur = None
        stat, held, now, bad = None, [], None, False

        def flush_clip():
            nonlocal held, bad
            if held and not bad:
                for k, row in held:
                    for f, s in SAMPLE_FIELDS.items():
                        b = row[f]
                        if b is None:
                            continue
                        info = tarfile.TarInfo(f"{k}.{s}")
                        info.size = len(b)
                        tar.addfile(info, io.BytesIO(bytes(b)))
                    stat["frames"] += 1
                stat["clips"] += 1
            elif held:
                stat["skipped_clips"] += 1
            held, bad = [], False

        def close():
            nonlocal tar
            if tar is not None:
                flush_clip()
                tar.close()
                final = os.path.join(folder, f"shard-{int(cur):06d}.tar")
                os.replace(tmp, final)
                stat["bytes"], stat["path"] = os.path.getsize(final), final
                tar = None
                return pd.DataFrame([stat])
            return None

        for p in batches:
            for row in p.to_dict("records"):
                if row[shard] != cur:
                    done = close()
                    if done is not None:
                        yield done
                    cur, now = row[shard], None
                    os.makedirs(folder, exist_ok=True)
                    tmp = os.path.join(folder, f".shard-{int(cur):06d}.{os.getpid()}.{id(p)}.tmp")
                    tar = tarfile.open(tmp, "w", format=tarfile.USTAR_FORMAT)
                    stat = {"shard_idx": int(cur), "clips": 0, "frames": 0, "skipped_clips": 0, "bytes": 0, "path": ""}
                if row[clip] != now:
                    flush_clip()
                    now = row[clip]
                bad = bad or any(row[f] is None for f in need)
                held.append((row["key"], row))
        done = close()
        if done is not None:
            yield done

    near = samples.where(F.col(shard).isNotNull()).repartition(shard).sortWithinPartitions(shard, *order)
    return near.select(shard, clip, *order, "key", *SAMPLE_FIELDS).mapInPandas(run, "shard_idx bigint, clips bigint, frames bigint, skipped_clips bigint, bytes bigint, path string")


def write_manifest(records: DataFrame, path: str, pos: str = "manifest_pos") -> None:
    """JSON lines in manifest order; nulls are kept."""
    records.orderBy(pos).drop(pos).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def sample_json(meta: dict) -> bytes:
    return json.dumps(meta).encode()
