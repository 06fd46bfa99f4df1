"""Texts placed in containers of fixed capacity by bin completion."""

from __future__ import annotations

import bisect
import itertools
from collections import Counter
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.llm.tokens import RANKS, token_counter
from framewright.session import checkpointed


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing: each size into the fullest container it fits."""
    rooms: list[tuple[int, int]] = []  # (room, container), sorted
    bins: list[list[int]] = []
    for s in sorted(sizes, reverse=True):
        i = bisect.bisect_left(rooms, (s, -1))
        if i == len(rooms):
            bins.append([s])
            room, b = capacity - s, len(bins) - 1
        else:
            room, b = rooms.pop(i)
            bins[b].append(s)
            room -= s
        bisect.insort(rooms, (room, b))
    return bins


def least_bins(sizes: list[int], capacity: int) -> int:
    """Lower bound on the containers needed: by total size, and by the items over half a container, which never share one.

    For each border up to half the capacity, items that leave less than the border stand alone, larger halves take a container each, and
    what the middling ones need beyond the room of those comes on top (Martello and Toth's second bound).
    """
    s = sorted(sizes, reverse=True)
    run = [0, *itertools.accumulate(s)]
    up = [-x for x in s]  # ascending, for bisection
    over = bisect.bisect_left(up, -(capacity // 2))  # items over half a container
    best = max(-(-run[-1] // capacity), over)
    for border in dict.fromkeys(s[over:]):
        alone, low = bisect.bisect_left(up, border - capacity), bisect.bisect_right(up, -border)
        spare = (over - alone) * capacity - (run[over] - run[alone])
        best = max(best, over - (-max(0, run[low] - run[over] - spare) // capacity))
    return best


def dominated(filling: list[int], slack: int, others: Iterable[int]) -> bool:
    """Whether some of ``filling`` could give way to one larger item of ``others`` (sizes left out) within the room.

    Items of sum t that an item x with t <= x <= t + slack replaces could go where x would have gone, so such a filling is never needed.
    Sums are the bits of one integer.
    """
    sums = 1
    for f in filling:
        sums |= sums << f
    window = (1 << slack + 1) - 1
    held = set(filling)
    for x in others:
        reach = (sums >> max(0, x - slack)) & (window >> max(0, slack - x))
        if x <= slack:
            reach &= ~1  # the empty sum is a matter of maximality
        if x in held:  # x in place of an equal x is no change
            only = sums_without(filling, x)
            reach = (only >> max(0, x - slack)) & (window >> max(0, slack - x)) & ~(1 if x <= slack else 0)
        if reach:
            return True
    return False


def sums_without(filling: list[int], x: int) -> int:
    sums = 1
    for f in filling:
        if f != x:
            sums |= sums << f
    return sums


def fillings(kinds: list[int], left: dict[int, int], room: int, width: int, nodes: int, quick: bool = False) -> list[tuple[int, list[int]]]:
    """Undominated maximal fillings of ``room`` by least waste, ``(waste, sizes)``; ``kinds`` ascending with ``left`` of each.

    Depth first with the largest first and as many of a size as fit, so of fillings of equal waste the first found has the largest
    items. The search ends once ``nodes`` were visited or ``width`` fillings stand with one that wastes nothing; what it has found by then
    counts, at least the first. ``quick`` ends it with the first undominated filling that wastes nothing, since none is better.
    """
    found: dict[int, list[int]] = {}
    taken: list[tuple[int, int]] = []  # (index in kinds, how many), indices falling
    top, seen, first, stock = len(kinds), 0, None, [k for k in kinds if left[k]]
    while True:
        while top := bisect.bisect_right(kinds, room, 0, top):
            top -= 1
            if n := min(left[kinds[top]], room // kinds[top]):
                taken.append((top, n))
                room -= n * kinds[top]
                seen += 1
        if room not in found and (len(found) < width or room < max(found)):  # only the best `width` are wanted
            used = dict(taken)
            if all(left[kinds[i]] <= used.get(i, 0) for i in range(bisect.bisect_right(kinds, room))):
                sizes = [kinds[i] for i, n in taken for _ in range(n)]
                first = first or (room, sizes)
                gone = {kinds[i] for i, n in taken if n == left[kinds[i]]}
                if not dominated(sizes, room, (k for k in stock if k not in gone)):
                    found[room] = sizes
                    if len(found) > width:
                        del found[max(found)]
        if not taken or seen >= nodes or (0 in found and (quick or len(found) >= width)):
            return sorted(found.items())[:width] or [first or (room, [])]
        top, n = taken.pop()  # one less of the smallest, then smaller ones in its room
        room += kinds[top]
        seen += 1
        if n > 1:
            taken.append((top, n - 1))


def complete_bins(sizes: list[int], capacity: int, width: int = 3, nodes: int = 120, budget: int = 4_000) -> tuple[list[list[int]], str]:
    """Containers for ``sizes`` (each at most ``capacity``) by bin completion, branch and bound, and how the search ended.

    Around the largest size left, undominated fillings are tried by least waste. A branch ends when the waste so far passes what
    the incumbent allows, at first the best-fit solution. The search ends at ``least_bins`` (``bound``: no solution has fewer), when nothing is
    left to try within ``width`` fillings a container (``searched``), or after ``budget`` containers beyond the first descent (``budget``), with the
    best solution so far: every item placed, never more containers than best fit.
    """
    if not sizes:
        return [], "bound"
    best = best_fit(sizes, capacity)
    total = sum(sizes)
    bound = least_bins(sizes, capacity)
    left = dict(Counter(sizes))
    kinds = sorted(left)
    stack: list[tuple[list[int], list, bool]] = []  # containers made, the fillings still to try at each, and whether others may be sought
    waste, spent, rest, end = 0, 0, len(sizes), budget + len(sizes)

    def around(quick: bool) -> list[list[int]]:
        """Fillings around the largest size left, by least waste."""
        while kinds and not left[kinds[-1]]:
            kinds.pop()
        first = kinds[-1]
        left[first] -= 1
        alts = [[first, *f] for _, f in fillings(kinds, left, capacity - first, width, nodes, quick)]
        left[first] += 1
        return alts

    def open_next() -> None:
        alts = around(True)
        stack.append(([], alts, sum(alts[0]) == capacity))

    if len(best) > bound:
        open_next()
    while stack and len(best) > bound and spent < end:
        used, alts, more = stack[-1]
        if used:  # take back
            for s in used:
                left[s] += 1
                rest += 1
                i = bisect.bisect_left(kinds, s)
                if i == len(kinds) or kinds[i] != s:
                    kinds.insert(i, s)
            waste -= capacity - sum(used)
            if more and not alts:  # the search for others ended with one that wastes nothing
                alts, more = [f for f in around(False) if f != used], False
            stack[-1] = ([], alts, more)
        if not alts:
            stack.pop()
            continue
        now = alts.pop(0)
        allowed = (len(best) - 1) * capacity - total  # a better solution wastes at most this
        if waste + capacity - sum(now) > allowed and rest > len(now):
            continue
        for s in now:
            left[s] -= 1
            rest -= 1
        waste += capacity - sum(now)
        stack[-1] = (now, alts, more)
        spent += 1
        if rest == 0:
            if len(stack) < len(best):
                best = [list(u) for u, _, _ in stack]
        else:
            open_next()
    return best, "bound" if len(best) <= bound else "searched" if spent < end else "budget"


def packer(turn: int, cols: list[str], search: dict):
    """The function that fills one block of one spec."""

    def pack(key: tuple, p: pd.DataFrame) -> pd.DataFrame:
        cap = int(p["capacity_tokens"].iloc[0])
        p = p.sort_values(["n_tokens", "doc_id", "part"], ascending=[False, True, True]).reset_index(drop=True)
        sizes = p["n_tokens"].tolist()
        by: dict[int, list[int]] = {}
        for i, s in enumerate(sizes):
            by.setdefault(s, []).append(i)
        box, place, fill = [""] * len(sizes), [0] * len(sizes), [0.0] * len(sizes)
        bins, ended = complete_bins(sizes, cap, **search)
        for b, used in enumerate(bins):
            at, share = 0, sum(used) / cap
            for s in used:
                i = by[s].pop()
                box[i], place[i], fill[i] = f"{key[0]}-{turn}-{key[1]}-{b}", at, share
                at += s
        return p.assign(container=box, place=place, fill=fill, search=ended)[cols]

    return pack


def fill_containers(documents: DataFrame, specs: DataFrame, path: str = RANKS, block: int = 2_000, full: float = 0.97, most: int = 50_000, **search: int) -> DataFrame:
    """Container and place of each text for each capacity.

    ``spec_id, capacity_tokens, doc_id, part, start_token, n_tokens, container, place, search``. A text over the capacity is cut
    into full containers and one rest; no other is cut. Texts of no token (null or empty) get one row without container. Specs
    without a positive capacity are dropped. Repeated texts are placed each.

    Blocks of about ``block`` items, hashed, are filled side by side (``search``: width, nodes and budget of ``complete_bins``; the column says how
    each block's search ended); what lies in containers under ``full`` is filled again in an eighth as many blocks, of about ``most`` items at most.
    Blocks fall strictly, so the turns end: with one block, with blocks that can't grow any more, or with a turn that frees no container, which
    is dropped. Of each spec about one container a block of the last turn is left partly empty, unless the sizes allow no better.
    """
    docs = checkpointed(documents.select("doc_id", token_counter(path)(F.col("text")).alias("n_tokens")))
    spec = specs.where("capacity_tokens > 0").select("spec_id", F.col("capacity_tokens").cast("bigint").alias("capacity_tokens"))
    rows = spec.limit(1001).collect()
    if len(rows) > 1000:
        raise ValueError("more than 1000 container specs")
    kind = spec.schema["spec_id"].dataType
    listed = F.array(*[F.struct(F.lit(r[0]).cast(kind).alias("spec_id"), F.lit(r[1]).cast("bigint").alias("capacity_tokens")) for r in rows]) if rows else F.array().cast(f"array<struct<spec_id:{kind.simpleString()},capacity_tokens:bigint>>")
    all_ = docs.withColumn("s", F.explode(listed)).select("s.spec_id", "s.capacity_tokens", "doc_id", "n_tokens")  # every text is placed for every spec
    c, n = F.col("capacity_tokens"), F.col("n_tokens")
    last = F.when(n > c, F.floor((n - 1) / c)).otherwise(0)
    parts = all_.where("n_tokens > 0").select("spec_id", "capacity_tokens", "doc_id", F.col("n_tokens").alias("t"), F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("part"))
    parts = parts.select("spec_id", "capacity_tokens", "doc_id", F.col("part").cast("int").alias("part"), (F.col("part") * c).alias("start_token"), F.least(F.col("t") - F.col("part") * c, c).alias("n_tokens"))
    whole = parts.where(n == c).withColumn("container", F.format_string("%s-full-%s-%d", F.col("spec_id").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "part")).withColumn("place", F.lit(0).cast("bigint")).withColumn("search", F.lit("full"))
    items = parts.where(n < c)
    schema = f"spec_id {kind.simpleString()}, capacity_tokens bigint, doc_id {dict(items.dtypes)['doc_id']}, part int, start_token bigint, n_tokens bigint, container string, place bigint, search string, fill double"
    cols = [x.split()[0] for x in schema.split(", ")]
    done: list[DataFrame] = [whole]

    def sizes_of(d: DataFrame) -> dict:
        """Items and containers per spec: at most 1000 rows."""
        return {r[0]: (r[1], r[2]) for r in d.groupBy("spec_id").agg(F.count("*"), F.count_if(F.col("place") == 0) if "place" in d.columns else F.lit(0)).collect()}

    size = sizes_of(items)
    blocks = {k: max(1, -(-x[0] // block)) for k, x in size.items()}
    turn, kept = 0, None
    while blocks:
        of = F.create_map(*[v for k, b in blocks.items() for v in (F.lit(k).cast(kind), F.lit(b))])
        mine = items.where(F.col("spec_id").isin(list(blocks)))
        packed = checkpointed(mine.withColumn("b", F.pmod(F.xxhash64("doc_id", "part", F.lit(turn)), F.try_element_at(of, F.col("spec_id")))).groupBy("spec_id", "b").applyInPandas(packer(turn, cols, search), schema))
        made = {k: x[1] for k, x in sizes_of(packed).items()}
        if kept is not None:  # of a spec whose turn freed nothing the older containers stay
            worse = [k for k in blocks if made[k] >= size[k][1]]
            done.append(kept.where(F.col("spec_id").isin(worse)))
            packed = packed.where(~F.col("spec_id").isin(worse))
            blocks = {k: b for k, b in blocks.items() if k not in worse}
        ends = [k for k, b in blocks.items() if b == 1]
        done += [packed.where(F.col("spec_id").isin(ends)), packed.where(~F.col("spec_id").isin(ends) & (F.col("fill") >= full))]
        kept = packed.where(~F.col("spec_id").isin(ends) & (F.col("fill") < full))
        items = kept.drop("container", "place", "fill", "search")
        size = sizes_of(kept)
        fewer = {k: max(1, blocks[k] // 8, -(-size[k][0] // most)) for k in size}
        stay = [k for k in size if fewer[k] >= blocks[k]]
        done.append(kept.where(F.col("spec_id").isin(stay)))
        blocks = {k: b for k, b in fewer.items() if k not in stay}
        turn += 1
    empty = all_.where("n_tokens = 0").select("spec_id", "capacity_tokens", "doc_id", F.lit(0).alias("part"), F.lit(0).cast("bigint").alias("start_token"), "n_tokens", F.lit(None).cast("string").alias("container"), F.lit(None).cast("bigint").alias("place"), F.lit(None).cast("string").alias("search"))
    out = empty
    for d in done:
        out = out.unionByName(d.drop("fill"))
    return out


def fill_report(placed: DataFrame) -> DataFrame:
    """Per spec: texts, tokens, containers, those of blocks whose search ended by its budget, the least number possible by size, and the share filled.

    A container's first item lies at place 0 and a text's first part is part 0, so counts need no distinct.
    """
    per = placed.where("container is not null").groupBy("spec_id", "capacity_tokens").agg(
        F.count_if(F.col("part") == 0).alias("texts"), F.sum("n_tokens").alias("tokens"), F.count_if(F.col("place") == 0).alias("containers"), F.count_if((F.col("place") == 0) & (F.col("search") == "budget")).alias("ended_by_budget")
    )
    return per.withColumn("least_containers", F.ceil(F.col("tokens") / F.col("capacity_tokens"))).withColumn("filled", F.round(F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")), 6))


def fill_check(placed: DataFrame, slack: int = 2) -> DataFrame:
    """Per spec, what any filling must keep: texts placed, containers over their capacity or with overlapping or missing places, texts cut
    although they fit, and whether the containers are within ``slack`` (and 1 %) of the least possible by size.
    """
    real = placed.where("container is not null")
    box = real.groupBy("spec_id", "capacity_tokens", "container").agg(F.sum("n_tokens").alias("t"), F.max(F.col("place") + F.col("n_tokens")).alias("z"), F.sum(F.col("n_tokens") * (2 * F.col("place") + F.col("n_tokens"))).alias("q"), F.min("place").alias("a"))
    # items laid end to end from 0 end at their sum, and the sum of (end^2 - start^2) is its square
    bad = (F.col("t") > F.col("capacity_tokens")) | (F.col("z") != F.col("t")) | (F.col("a") != 0) | (F.col("q") != F.col("t") * F.col("t"))
    per = box.groupBy("spec_id", "capacity_tokens").agg(F.count_if(bad).alias("bad_containers"), F.count("*").alias("k"), F.sum("t").alias("t"))
    one = real.groupBy("spec_id", "doc_id").agg(F.count("*").alias("parts"), F.sum("n_tokens").alias("t"), F.max("capacity_tokens").alias("c"))
    cut = one.groupBy("spec_id").agg(F.count("*").alias("texts"), F.count_if(F.col("parts") != F.ceil(F.col("t") / F.col("c"))).alias("cut_texts"))
    return per.join(cut, "spec_id").select("spec_id", "texts", "bad_containers", "cut_texts", (F.col("k") <= F.ceil(F.col("t") / F.col("capacity_tokens")) * 1.01 + slack).alias("near_bound"))
