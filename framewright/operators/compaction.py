"""Small files: which frames are stored again, a plan of well-sized files, and a guarded rewrite of a table's partitions."""

from __future__ import annotations

import json
import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framewright.functions.keys import frame_clip, frame_number
from framewright.session import checkpointed, guarded_join, salted_join, written


def stored_frames(listings: DataFrame) -> DataFrame:
    """One row per member that is a frame: ``tar_path, member, name, clip_id, frame_idx, offset, size, known, tar_bytes, listed_at``.

    A file listed twice is one file (its first listing counts; listings without ``tar_path`` are dropped). A member
    whose offset is missing counts as stored; its size is the file's mean and ``known`` is false.
    """
    one = listings.where("tar_path is not null").groupBy("tar_path").agg(F.min_by(F.struct("frame_names", "frame_offsets", "tar_bytes", "listed_at"), "listing_id").alias("r")).select("tar_path", "r.*")
    n = F.size("frame_names")
    m = one.select("tar_path", "frame_offsets", "tar_bytes", "listed_at", n.alias("n"), F.posexplode("frame_names").alias("member", "name"))
    off = F.get(F.col("frame_offsets"), F.col("member"))
    size = F.get(off, F.lit(1))
    return m.select(
        "tar_path", "member", "name", frame_clip(F.col("name")).alias("clip_id"), frame_number(F.col("name")).alias("frame_idx"), F.get(off, F.lit(0)).alias("offset"),
        F.coalesce(size, F.ceil(F.col("tar_bytes") / F.col("n"))).alias("size"), size.isNotNull().alias("known"), "tar_bytes", "listed_at",
    ).where("clip_id is not null and frame_idx is not null")


def folder_of(path: str, depth: int) -> Column:
    """The partition of a tar file: the folder ``depth`` levels above it."""
    return F.regexp_replace(path, rf"(/[^/]*){{{depth}}}$", "")


def held_frames(listings: DataFrame, depth: int = 2) -> DataFrame:
    """Each frame once: ``clip_id, frame_idx, part, tar_path, member, size, known`` of the copy a compacted table holds, and ``copies, parts``.

    Of several copies one of known, non-zero size is taken, the earliest listed first, then by path and place. ``parts`` are the
    partitions that hold any copy.
    """
    fr = stored_frames(listings).withColumn("part", folder_of("tar_path", depth))
    rank = F.struct((~(F.col("known") & (F.col("size") > 0))).alias("bad"), "listed_at", "tar_path", "member")
    g = fr.groupBy("clip_id", "frame_idx").agg(F.min_by(F.struct("part", "tar_path", "member", "size", "known"), rank).alias("r"), F.count("*").alias("copies"), F.collect_set("part").alias("parts"))
    return g.select("clip_id", "frame_idx", "r.*", "copies", "parts")


def repeated_frames(listings: DataFrame) -> DataFrame:
    """Frames stored more than once, in different tar files or twice in one: ``clip_id, frame_idx``, those of which compaction drops a copy."""
    return held_frames(listings).where("copies > 1").select("clip_id", "frame_idx")


def two_level_running_sum(df: DataFrame, part: str, order: list[str], value: str, out: str, buckets: int = 256) -> DataFrame:
    """Exclusive running sum of ``value`` within ``part`` in the order (hash bucket, ``order``), without gathering a part.

    Rows are summed within (part, bucket); a bucket's start is the sum of the buckets before it, from one row each.
    """
    b = df.withColumn("__bk", F.pmod(F.xxhash64(order[0]), F.lit(buckets)))
    w = Window.partitionBy(part, "__bk").orderBy(*order)
    sums = b.groupBy(part, "__bk").agg(F.sum(value).alias("__bs"))
    start = F.sum("__bs").over(Window.partitionBy(part).orderBy("__bk")) - F.col("__bs")
    inner = F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.col(value)
    joined = guarded_join(b.withColumn("__in", inner), sums.select(part, "__bk", start.alias("__st")), [part, "__bk"], "inner")
    return joined.withColumn(out, F.col("__in") + F.col("__st")).drop("__bk", "__in", "__st")


def compaction_plan(listings: DataFrame, target_bytes: int = 64 << 20, small_bytes: int = 16 << 20, max_small: int = 4, depth: int = 2) -> DataFrame:
    """A plan of fewer, well-sized tar files in which every frame named is held exactly once.

    A partition is the folder ``depth`` levels above a tar file. It is rewritten if it has more than ``max_small`` files under
    ``small_bytes``, or holds any copy of a frame that is stored more than once (else a copy would stay behind in a file that is kept); partitions
    with neither stay as they are (``action`` = ``keep``: one row per frame, in its present file). Whole clips are laid out one after the
    other, and a clip that would pass ``target_bytes`` opens the next file, so a file holds at most the target plus one clip. Partitions
    that fill less than a quarter of a file are laid out together with the others of their parent folder.

    Rows: ``part, action, out_path, clip_id, frame_idx, tar_path, member, size, known``.
    """
    held = checkpointed(held_frames(listings, depth))
    files = listings.where("tar_path is not null").groupBy("tar_path").agg(F.max("tar_bytes").alias("b")).withColumn("part", folder_of("tar_path", depth))
    twice = held.where("copies > 1").select(F.explode("parts").alias("part")).distinct().withColumn("twice", F.lit(True))
    parts = files.groupBy("part").agg(F.count_if(F.col("b") < small_bytes).alias("ns")).join(twice, "part", "left").select("part", ((F.col("ns") > max_small) | F.col("twice").isNotNull()).alias("rewrite"))
    block = 512  # tar members are padded to this and have a header of as much
    padded = F.ceil(F.col("size") / block) * block + block
    clips = held.groupBy("part", "clip_id").agg(F.sum(padded).alias("cb"))
    whole = clips.groupBy("part").agg(F.sum("cb").alias("pb")).join(parts, "part")
    up = F.regexp_extract("part", r"^(.*)/[^/]+$", 1)
    whole = whole.select("part", "rewrite", F.when((F.col("pb") * 4 < target_bytes) & (up != ""), up).otherwise(F.col("part")).alias("into"))
    placed = two_level_running_sum(guarded_join(clips, whole, ["part"], "inner"), "into", ["clip_id", "part"], "cb", "at")
    placed = placed.select("part", "clip_id", "rewrite", F.format_string("%s/compact-%06d.tar", "into", F.floor(F.col("at") / target_bytes)).alias("out"))
    return salted_join(held, placed, ["part", "clip_id"]).select(
        "part", F.when(F.col("rewrite"), "rewrite").otherwise("keep").alias("action"), F.when(F.col("rewrite"), F.col("out")).otherwise(F.col("tar_path")).alias("out_path"),
        "clip_id", "frame_idx", "tar_path", "member", "size", "known",
    )


class Conflict(RuntimeError):
    """Another writer changed a partition between reading and committing."""


class SnapshotTable:
    """A Parquet table in a folder with numbered snapshots, each a JSON list of its files by partition.

    A snapshot is committed by creating its file exclusively, so two writers can't both commit version ``v + 1``. A writer that
    lost the race commits on top of the newer version if that left its partitions alone, and raises Conflict otherwise. Readers see
    the files of one snapshot only; files of an earlier one stay until ``vacuum``.
    """

    def __init__(self, spark: SparkSession, path: str, part: str):
        self.spark, self.path, self.part = spark, path.rstrip("/"), part
        jvm = spark.sparkContext._jvm
        self._p = jvm.org.apache.hadoop.fs.Path
        self._fs = self._p(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _log(self, v: int) -> str:
        return f"{self.path}/_snapshots/{v:012d}.json"

    def version(self) -> int:
        folder = self._p(f"{self.path}/_snapshots")
        if not self._fs.exists(folder):
            return 0
        return max([int(s.getPath().getName()[:12]) for s in self._fs.listStatus(folder) if not s.getPath().getName().startswith(".") and s.getPath().getName().endswith(".json") and s.getPath().getName()[:12].isdigit()], default=0)

    def files(self, v: int | None = None) -> dict[str, list[list]]:
        """``{partition: [[file, bytes, rows], ...]}`` of a snapshot."""
        v = self.version() if v is None else v
        if not v:
            return {}
        return json.loads("".join(r[0] for r in self.spark.read.text(self._log(v), wholetext=True).collect()))

    def _commit(self, base: int, changed: dict[str, list[list]]) -> int:
        before = self.files(base)
        while True:
            now = self.version()
            files = self.files(now)
            for p in changed:
                if files.get(p) != before.get(p):
                    raise Conflict(f"partition {p} changed between versions {base} and {now}")
            files.update(changed)
            body = json.dumps({k: x for k, x in files.items() if x})
            if self._publish(now + 1, body):
                return now + 1

    def _publish(self, v: int, body: str) -> bool:
        """Write the snapshot aside, then rename it to its name, which must be free: a reader sees all of it or nothing."""
        aside, name = self._p(f"{self.path}/_snapshots/.{uuid.uuid4().hex}.tmp"), self._p(self._log(v))
        out = self._fs.create(aside, False)
        out.write(bytearray(body.encode()))
        out.close()
        none = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename.NONE
        kinds = self.spark.sparkContext._gateway.new_array(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        kinds[0] = none
        context = self.spark.sparkContext._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        try:
            context.rename(self._fs.makeQualified(aside), self._fs.makeQualified(name), kinds)  # fails if the name is taken
            return True
        except Exception:
            self._fs.delete(aside, False)
            if self._fs.exists(name):  # someone else committed this version
                return False
            raise

    def _write(self, df: DataFrame) -> dict[str, list[list]]:
        """Write ``df`` into a new generation folder; its files by partition."""
        uid = uuid.uuid4().hex
        gen = f"{self.path}/data/{uid}"
        df.write.partitionBy(self.part).parquet(gen)
        got: dict[str, list[list]] = {}
        meta = self.spark.read.parquet(gen).groupBy(F.input_file_name().alias("f"), F.col(self.part).cast("string").alias("p")).agg(F.count("*").alias("n"))
        sizes = {}
        it = self._fs.listFiles(self._p(gen), True)
        while it.hasNext():
            s = it.next()
            sizes[s.getPath().toString().rsplit(f"/{uid}/", 1)[1]] = (s.getPath().toString(), s.getLen())
        for r in meta.collect():  # one row per file of this commit
            path, b = sizes[unquote(r["f"]).rsplit(f"/{uid}/", 1)[1]]
            got.setdefault(r["p"] if r["p"] is not None else "", []).append([path, b, r["n"]])
        return got

    def append(self, df: DataFrame) -> int:
        base = self.version()
        new, old = self._write(df), self.files(base)
        return self._commit(base, {p: old.get(p, []) + x for p, x in new.items()})

    def _load(self, files: list[str]) -> DataFrame:
        return self.spark.read.option("basePath", f"{self.path}/data/").option("recursiveFileLookup", "false").parquet(*files)

    def read(self, v: int | None = None, partitions: list[str] | None = None) -> DataFrame:
        names = [f[0] for p, x in self.files(v).items() for f in x if partitions is None or p in partitions]
        if not names:
            raise ValueError("this snapshot holds no files")
        by_gen: dict[str, list[str]] = {}
        for n in names:
            by_gen.setdefault(n.split("/data/", 1)[1].split("/", 1)[0], []).append(n)
        dfs = [self.spark.read.option("basePath", f"{self.path}/data/{g}").parquet(*x) for g, x in by_gen.items()]
        out = dfs[0]
        for d in dfs[1:]:
            out = out.unionByName(d, allowMissingColumns=True)
        return out

    def compact(self, target_bytes: int = 128 << 20, small_bytes: int = 32 << 20, max_small: int = 4) -> int | None:
        """Rewrite only partitions of more than ``max_small`` files under ``small_bytes``; the new version, or None if there are none.

        The rewrite replaces those partitions as a whole in the next snapshot (others keep their files). It is
        committed only if row counts and content sums of every partition are the same before and after.
        """
        base = self.version()
        files = self.files(base)
        todo = {p: x for p, x in files.items() if sum(f[1] < small_bytes for f in x) > max_small}
        if not todo:
            return None
        pieces = {p: max(1, -(-sum(f[1] for f in x) // target_bytes)) for p, x in todo.items()}
        df = written(self.read(base, list(todo)))
        keyed = df.withColumn("__p", F.coalesce(F.col(self.part).cast("string"), F.lit("")))
        n = self.spark.createDataFrame(list(pieces.items()), "__p string, __k int")
        spread = keyed.join(F.broadcast(n), "__p").withColumn("__r", F.pmod(F.xxhash64(*df.columns), F.col("__k")))
        spread = spread.repartition(max(1, sum(pieces.values())), "__p", "__r").drop("__p", "__r", "__k")
        new = self._write(spread)
        sums = lambda d: {r[0]: (r[1], r[2]) for r in d.groupBy(F.coalesce(F.col(self.part).cast("string"), F.lit(""))).agg(F.count("*"), F.sum(F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)"))).collect()}
        after = self.spark.read.parquet(*{x[0].split("/data/")[0] + "/data/" + x[0].split("/data/")[1].split("/")[0] for v in new.values() for x in v})
        after = after.select(*[F.col(c).cast(t) for c, t in df.dtypes])
        if sums(df) != sums(after):
            raise RuntimeError("the rewritten partitions differ from what was read; nothing was committed")
        return self._commit(base, {p: new.get(p, []) for p in todo})


def rewritten(df: DataFrame, folder: str, part: str, pieces: int = 8, max_small: int = 4, **sizes: int) -> DataFrame:
    """``df`` written to a snapshot table in ``pieces`` appends, compacted, and compared: a row per partition.

    ``part, rows, files_before, files_after, same``: ``same`` if row count and content sum are those of ``df``.
    """
    t = SnapshotTable(df.sparkSession, folder, part)
    keyed = written(df.withColumn("__piece", F.pmod(F.xxhash64(*df.columns), F.lit(pieces))))
    for i in range(pieces):
        t.append(keyed.where(F.col("__piece") == i).drop("__piece").coalesce(1))
    before = t.version()
    t.compact(max_small=max_small, **sizes)
    n = lambda v, name: df.sparkSession.createDataFrame([(p, len(x)) for p, x in t.files(v).items()], f"{part} string, {name} int")
    key = F.col(part).cast("string").alias(part)
    sums = lambda d, c: d.groupBy(key).agg(F.count("*").alias(f"n{c}"), F.sum(F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)")).alias(f"h{c}"))
    j = sums(keyed.drop("__piece"), 0).join(sums(t.read().select(*[F.col(c).cast(k) for c, k in df.dtypes]), 1), part, "full").join(n(before, "files_before"), part, "left").join(n(None, "files_after"), part, "left")
    return j.select(part, F.col("n1").alias("rows"), "files_before", "files_after", (F.col("n0").eqNullSafe(F.col("n1")) & F.col("h0").eqNullSafe(F.col("h1"))).alias("same"))
