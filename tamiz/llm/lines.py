"""Problem 1: lines repeated across the documents of one source.

1. One pass cuts each text into lines and folds them. A line's key is the hash of its journal and of its letters and digits without
   case and accents. Its mask has numbers and dates as 0 and capitalised names inside the line as X; the set of the mask's five-word
   shingles, as hashes of 24 bits in order, is kept once for each mask of a journal. No text is shuffled.
2. (key, pid) is made distinct, then counted by key: two steps, so no journal and no line is a hot group.
3. Locality-sensitive hashing within a journal: BANDS bands of ROWS least hashes each; masks that agree in a band share a bucket. Two sets
   of Jaccard similarity 0.8 share one with probability 0.998, of 0.85 with 0.9995, of 0.9 with 0.99995. A set's parity is 96 bits, each shingle
   turns one over: parities differ in no more bits than the sets do in shingles, so members without another of fit parity and size go.
   Sets of fewer than WIDE shingles keep it folded to 48 bits, which tells them apart; of long lines 48 bits let many unlike pairs pass.
   The others are compared by the exact similarity. A bucket with more than HOT of them, or of more than DENSE members, is no task's group:
   its members are spread over buckets of a shingle each, the rarest in that bucket first, of which two sets of 0.8 share one (prefix
   filter); no link is lost.
4. The links are followed to a fixed point; a component is a cluster. It is boilerplate if its lines occur in at least ``least``
   distinct pids and ``share`` of the journal's distinct pids.
5. ``exact=True`` then checks the lines of these clusters: each has to reach both bounds by itself.
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, journal, narrowed, release, scan

SHINGLE = 5
SIMILAR = (4, 5)  # the least Jaccard similarity of a pair, 0.8, as a fraction
_WORDS = re.compile(r"[^\W_]+")
_MASK = (1 << 64) - 1
_CHUNK = 4_000
ROWS, BANDS = 2, 6
HOT = 3_000  # members of a bucket that one task compares by their sets
DENSE = 20_000  # and by their parities
_WIDTH = 3  # bytes of a shingle's hash in a set
WIDE = 40  # shingles from which a set's parity is not folded


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def bare(text: str) -> str:
    """A text without accents; case stays, lines stay lines."""
    return text if text.isascii() else _ACCENT.sub("", unicodedata.normalize("NFD", text))


_ACCENT = re.compile("[\u0300-\u036f]+")


def mask(words: list[str]) -> list[str]:
    """A line's words in lower case, with numbers and dates as 0 and names as x: words with a capital, after the first, in mixed case."""
    mixed = any(map(str.islower, words))
    out = ["0" if w[0].isdigit() else w.lower() if i == 0 or not mixed or not w[0].isupper() else "x" for i, w in enumerate(words)]
    return [w for i, w in enumerate(out) if w not in ("x", "0") or i == 0 or out[i - 1] != w]


class _Hashes(dict):
    def __missing__(self, w: str) -> int:
        out = self[w] = xxhash.xxh64_intdigest(w)
        return out


_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    """Another hash of each hash."""
    with np.errstate(over="ignore"):
        y = (x + np.uint64(salt) * _GOLDEN) * np.uint64(0xFF51AFD7ED558CCD)
        y ^= y >> np.uint64(32)
        return y * np.uint64(0xC4CEB9FE1A85EC53)


def shingles(masks: list[list[str]], known: dict[str, int]) -> list[bytes]:
    """The set of each mask's shingles: different hashes of 24 bits, least first, packed."""
    sizes = np.array([max(len(m), SHINGLE) for m in masks])
    flat = np.array([h for m in masks for h in (*map(known.__getitem__, m), *(0,) * (SHINGLE - len(m)))], dtype=np.uint64)
    with np.errstate(over="ignore"):
        total = np.zeros(len(flat) - SHINGLE + 1, dtype=np.uint64)
        for j in range(SHINGLE):
            total += flat[j:len(flat) - SHINGLE + 1 + j] * np.uint64((0x9E3779B97F4A7C15 + 2 * j * 0x632BE59BD9B4E019) & _MASK | 1)
        total ^= total >> np.uint64(33)
        total *= np.uint64(0xFF51AFD7ED558CCD)
        total ^= total >> np.uint64(29)
    line = np.repeat(np.arange(len(masks), dtype=np.uint64), sizes)[: len(total)]
    whole = np.arange(len(total)) + SHINGLE <= np.cumsum(sizes)[line.astype(np.int64)]
    both = np.unique((line[whole] << np.uint64(32)) | (total[whole] >> np.uint64(40)))
    packed = (both & np.uint64(0xFFFFFF)).astype("<u4").view(np.uint8).reshape(-1, 4)[:, :_WIDTH].tobytes()
    starts = np.searchsorted(both >> np.uint64(32), np.arange(len(masks) + 1, dtype=np.uint64))
    return [packed[a * _WIDTH:b * _WIDTH] for a, b in zip(starts, starts[1:])]


def banded(batches):
    """(bucket, m, parity, wide) for each band of sets (j, m, s), none of them empty.

    A bucket is a hash of the journal and the band; parity is folded, with the set's size in the last 16 bits; wide is the upper half
    of the parity before it was folded, 0 for sets of fewer than WIDE.
    """
    for b in batches:
        if not b.num_rows:
            continue
        sets = b.column("s").cast(pa.binary())
        at = np.frombuffer(sets.buffers()[1], dtype=np.int32)[sets.offset:sets.offset + len(sets) + 1]
        wide = np.zeros(((at[-1] - at[0]) // _WIDTH, 4), dtype=np.uint8)
        wide[:, :_WIDTH] = np.frombuffer(sets.buffers()[2], dtype=np.uint8)[at[0]:at[-1]].reshape(-1, _WIDTH)
        token = wide.view("<u4").ravel().astype(np.uint64)
        starts, n = (at[:-1] - at[0]) // _WIDTH, np.diff(at) // _WIDTH
        bit = np.uint64(1) << (token % np.uint64(48))
        parity = np.bitwise_xor.reduceat(bit, starts) << np.uint64(16) | np.minimum(n, 0xFFFF).astype(np.uint64)
        upper = np.where(n < WIDE, np.uint64(0), np.bitwise_xor.reduceat(np.where(token % np.uint64(96) < 48, np.uint64(0), bit), starts))
        j = b.column("j").to_numpy().view(np.uint64)
        for band in range(BANDS):
            h = np.full(len(n), band, dtype=np.uint64)
            for row in range(ROWS):
                h = _mixed(h ^ np.minimum.reduceat(_mixed(token, 1 + band * ROWS + row), starts), 99)
            columns = (_mixed(h ^ j, 98).view(np.int64), b.column("m"), parity.view(np.int64), upper.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(x) if isinstance(x, np.ndarray) else x for x in columns], names=["bucket", "m", "parity", "wide"])


def unpacked(s: bytes) -> list[int]:
    """The hashes of a set, least first."""
    wide = np.zeros((len(s) // _WIDTH, 4), dtype=np.uint8)
    wide[:, :_WIDTH] = np.frombuffer(s, dtype=np.uint8).reshape(-1, _WIDTH)
    return wide.view("<u4").ravel().tolist()


def prefix(n: int) -> int:
    """How many of a set's n least shingles one of 0.8 has to share one of."""
    return n - -(-n * SIMILAR[0] // SIMILAR[1]) + 1


def keyed_lines(df: DataFrame, key: str = "task_id", pid: str = "pid", text: str = "text", shortest: int = 30) -> DataFrame:
    """Two kinds of rows, so that one pass over the texts makes both and both are small.

    (t, p, j, ns, ks) for a text: hashes of its pid and journal, numbers and keys of its lines of at least ``shortest`` letters and digits.
    (fk, fm, sj, sm, ss) for a stretch of texts: the different keys in it with their masks' hashes; journals, hashes and shingle sets of
    the different masks that another can be similar to. What an earlier stretch of the task has is mostly left out. A mask's hash is
    that of its journal and shingles.
    """
    kind = df.schema[key].dataType.simpleString()

    def rows(it):
        known = _Hashes()
        fresh: dict[int, tuple[int, list[str]]] = {}
        given: set[int] = set()  # keys
        given_masks: set[int] = set()

        def flush():
            if fresh:
                sets = shingles([m for _, m in fresh.values()], known)
                ms = [signed(xxhash.xxh64_intdigest(x, j & _MASK)) for (j, _), x in zip(fresh.values(), sets)]
                # sets of up to three are similar only to equal ones
                once = {m: (j, x) for m, (j, _), x in zip(ms, fresh.values(), sets) if len(x) > 3 * _WIDTH and m not in given_masks}
                js, xs = zip(*once.values()) if once else ((), ())
                yield None, None, None, None, None, list(fresh), ms, js, list(once), xs
                given.update(fresh)
                given_masks.update(once)
            fresh.clear()
            for x in (known, given, given_masks):
                if len(x) > 500_000:
                    x.clear()

        for k, p, t in it:
            site, ns, ks = p[1:10], [], []
            j = signed(xxhash.xxh64_intdigest(site))
            for n, line in enumerate(bare(t).split("\n"), 1):
                if len(line) < shortest:
                    continue
                words = _WORDS.findall(line)
                s = "".join(words)
                if len(s) < shortest:
                    continue
                h = signed(xxhash.xxh64_intdigest(f"{site}\n{s.lower()}"))
                ns.append(n)
                ks.append(h)
                if h not in fresh and h not in given:
                    fresh[h] = (j, mask(words))
            if ns:
                yield k, signed(xxhash.xxh64_intdigest(p)), j, ns, ks, None, None, None, None, None
            if len(fresh) > _CHUNK:
                yield from flush()
        yield from flush()

    schema = f"t {kind}, p bigint, j bigint, ns array<int>, ks array<bigint>, fk array<bigint>, fm array<bigint>, sj array<bigint>, sm array<bigint>, ss array<binary>"
    return scan(df.where(F.col(text).isNotNull() & F.col(pid).isNotNull()).select(key, pid, text), schema, rows)


def links(sets: DataFrame) -> DataFrame:
    """(m, to): masks of a journal that share a bucket and are at least 0.8 similar, enough of them to join all that are.

    sets is (j, m, s), rows may repeat.
    """
    buckets = sets.select("j", "m", "s").mapInArrow(banded, "bucket bigint, m bigint, parity bigint, wide bigint")
    near = buckets.repartition("bucket").sortWithinPartitions("bucket", F.expr("parity & 65535"), "m").mapInArrow(fit, "bucket bigint, m bigint, hot boolean")
    members = cut(near)
    del buckets, near
    one = narrowed(sets.select("m", "s"), members, "m").groupBy("m").agg(F.first("s").alias("s"))
    both = cut(members.join(one, "m"))
    release(both)  # the shuffle of all buckets
    hot = both.where("hot").select("bucket", "m", "s")
    rows = both.where("not hot").select("bucket", "m", "s")
    if not hot.isEmpty():
        rows = rows.unionByName(spread_bucket(hot))
    return cut(scan(rows.repartition("bucket").sortWithinPartitions("bucket", "m"), "m bigint, to bigint", compare).distinct())


def spread_bucket(hot: DataFrame) -> DataFrame:
    """(bucket, m, s) of the members (bucket, m, s) of large buckets, in a smaller one for each of their rarest shingles.

    Of two sets of 0.8 the prefixes share a shingle in any order, so also in that of their counts in the bucket. Counts are summed
    before they are shuffled, and a member meets them by (bucket, shingle); no bucket is a group.
    """
    tokens = scan(hot, "bucket bigint, m bigint, n int, token int", lambda it: ((b, m, len(s) // _WIDTH, t) for b, m, s in it for t in unpacked(s)))
    counted = tokens.groupBy("bucket", "token").agg(F.count(F.lit(1)).alias("c"))
    order = F.array_sort(F.collect_list(F.struct("c", "token")))  # of one set
    ranked = tokens.join(counted, ["bucket", "token"]).groupBy("bucket", "m", "n").agg(order.alias("o"))
    least = F.col("n") - F.ceil(F.col("n") * SIMILAR[0] / SIMILAR[1]).cast("int") + 1
    first = ranked.select("bucket", "m", F.explode(F.slice("o.token", F.lit(1), least)).alias("token"))
    return first.join(hot, ["bucket", "m"]).select(F.xxhash64("bucket", "token").alias("bucket"), "m", "s")


def fit(batches):
    """Of buckets' members, in order of bucket, size and mask, those with another in their bucket that can be 0.8 similar by size and parity.

    They are marked if they are more than HOT. All members of a bucket of more than DENSE are let through, marked; it is looked at only as
    far as that is known.
    """
    def some(t: pa.Table) -> pa.RecordBatch:
        bucket, m, parity, wide = (t.column(c).to_numpy() for c in ("bucket", "m", "parity", "wide"))
        first = np.ones(len(m), dtype=bool)
        first[1:] = (bucket[1:] != bucket[:-1]) | (m[1:] != m[:-1])
        bucket, m, parity, wide = (x[first] for x in (bucket, m, parity, wide))
        n, parity = parity & 0xFFFF, parity >> 16 & (1 << 48) - 1
        start = np.flatnonzero(np.diff(bucket, prepend=~bucket[0]))
        size = np.diff(np.append(start, len(m)))
        good = np.repeat(size > DENSE, size)
        i, away = np.flatnonzero(~good), 0
        while len(i):  # each member with the one next to it, then the one after, as far as the sizes go
            away += 1
            i = i[i + away < len(m)]
            i = i[(bucket[i] == bucket[i + away]) & (n[i + away] * SIMILAR[0] <= n[i] * SIMILAR[1])]
            folded = parity[i] ^ parity[i + away]
            upper = np.where(n[i] < WIDE, 0, wide[i] ^ wide[i + away])  # the next is no smaller
            apart = np.bitwise_count(upper.view(np.uint64)).astype(np.int64) + np.bitwise_count((folded ^ upper).view(np.uint64))
            both = i[apart * sum(SIMILAR) <= (n[i] + n[i + away]) * (SIMILAR[1] - SIMILAR[0])]
            good[both] = good[both + away] = True
        hot = np.repeat(np.add.reduceat(good.astype(np.int64), start) > HOT, size)
        return pa.RecordBatch.from_arrays([pa.array(x[good]) for x in (bucket, m, hot)], names=["bucket", "m", "hot"])

    held, rows, passing = [], 0, None
    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b])
        if passing is not None:  # the rest of a bucket that is known to be large
            end = int(np.searchsorted(t.column("bucket").to_numpy(), passing, side="right"))
            if end:
                m = t.column("m").slice(0, end).combine_chunks()
                yield pa.RecordBatch.from_arrays([pa.array(np.full(end, passing)), m, pa.array(np.ones(end, dtype=bool))], names=["bucket", "m", "hot"])
            t = t.slice(end)
            if not t.num_rows:
                continue
            passing = None
        held += t.to_batches()
        rows += t.num_rows
        if rows < 100_000:
            continue
        t = pa.Table.from_batches(held)
        end = int(np.searchsorted(t.column("bucket").to_numpy(), t.column("bucket")[t.num_rows - 1].as_py()))  # the last bucket may go on
        if end:
            yield some(t.slice(0, end))
        t = t.slice(end)
        if t.num_rows > DENSE and len(np.unique(t.column("m").to_numpy())) > DENSE:
            passing = t.column("bucket")[0].as_py()
            yield some(t)
            t = t.slice(t.num_rows)
        held, rows = t.to_batches(), t.num_rows
    if held and rows:
        yield some(pa.Table.from_batches(held))


def compare(rows):
    """The links of buckets, given as rows (bucket, mask, set) in order.

    Each member is compared with those before it, but for ones that are joined with it already. A set similar to it shares one of
    the least prefix() shingles, so only members with one in common are looked at.
    """
    bucket = None
    for b, m, s in rows:
        if b != bucket:
            bucket, index, sets, group, held = b, {}, [], [], set()
        if m in held:
            continue
        held.add(m)
        x = unpacked(s)
        n, mine = len(x), frozenset(x)
        least = x[: prefix(n)]
        me = len(sets)
        group.append(me)
        done = set()
        for t in least:
            for other in index.get(t, ()):
                if other in done:
                    continue
                done.add(other)
                to, theirs = sets[other]
                k = len(theirs)
                if min(n, k) * SIMILAR[1] < max(n, k) * SIMILAR[0] or _root(group, other) == _root(group, me):
                    continue
                both = len(mine & theirs)
                if both * SIMILAR[1] >= (n + k - both) * SIMILAR[0]:
                    a, c = sorted((_root(group, other), _root(group, me)))
                    group[c] = a
                    yield m, to
        for t in least:
            index.setdefault(t, []).append(me)
        sets.append((m, mine))


def _root(group: list[int], i: int) -> int:
    while group[i] != i:
        group[i] = i = group[group[i]]
    return i


def components(pairs: DataFrame) -> DataFrame:
    """(m, cluster): the least mask that each mask of the links (m, to) is joined with, by large and small stars to a fixed point."""
    edges, before = pairs.select(F.greatest("m", "to").alias("m"), F.least("m", "to").alias("to")), None
    while True:
        both = edges.unionByName(edges.select(F.col("to").alias("m"), F.col("m").alias("to")))
        low = both.groupBy("m").agg(F.least(F.col("m"), F.min("to")).alias("low"))
        large = cut(both.join(low, "m").where("to > m").select(F.col("to").alias("m"), F.col("low").alias("to")).distinct())
        low = large.groupBy("m").agg(F.min("to").alias("low"))
        small = large.join(low, "m")
        edges = cut(small.select(F.col("to").alias("m"), F.col("low").alias("to")).where("m > to").unionByName(low.select("m", F.col("low").alias("to"))).distinct())
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("m", "to")), F.sum(F.shiftright(F.xxhash64("to", "m"), 32))).first()
        if now == before:  # all are stars
            break
        before = now
    return edges.select("m", F.col("to").alias("cluster")).unionByName(edges.select(F.col("to").alias("m"), F.col("to").alias("cluster")).distinct())


def clusters(keys: DataFrame, sets: DataFrame) -> DataFrame:
    """(k, cluster) of all keys of clusters of several keys; keys is (k, m), sets is that of links(), rows may repeat."""
    tree = components(links(sets))
    masks = keys.groupBy("m").agg(F.min("k").alias("low"), F.max("k").alias("top"))
    near = cut(masks.join(tree, "m", "left").where("cluster is not null or low < top").select("m", F.coalesce("cluster", "m").alias("c"), "low", "top"))
    several = near.groupBy("c").agg(F.min("low").alias("cluster"), F.max("top").alias("top")).where("cluster < top").select("c", "cluster")
    named = cut(near.join(several, "c").select("m", "cluster"))
    return narrowed(keys, named, "m").distinct().join(named, "m").select("k", "cluster")


def repeated_lines(df: DataFrame, key: str = "task_id", pid: str = "pid", text: str = "text", least: int = 5, share_pm: int = 50, exact: bool = False) -> DataFrame:
    """(key, line_no, cluster, cluster_pids, line_pids) for each occurrence of an excessively repeated line; see the module.

    ``share_pm`` is the share of the journal's pids in thousandths. A null pid belongs to no journal, so its lines are never found.
    Null and blank texts count among the journal's pids. Repeated rows and several tasks of a pid count as one pid. Other columns are
    not read; an empty table gives an empty result. Pids, journals and lines are told apart by 64-bit hashes.
    """
    both = cut(keyed_lines(df, key, pid, text))
    texts = both.where("t is not null")
    counts = (
        texts.select("p", "j", F.explode("ks").alias("k")).groupBy("k", "p").agg(F.first("j").alias("j"))
        .groupBy("k").agg(F.count(F.lit(1)).alias("line_pids"), F.first("j").alias("j"))
    )
    total = _totals(df, pid)
    often = lambda n: (F.col(n) >= least) & (F.col(n) * 1000 >= F.col("pids") * share_pm)
    stretch = both.where("t is null")
    keys = stretch.select(F.inline(F.arrays_zip("fk", "fm"))).toDF("k", "m")
    sets = stretch.select(F.inline(F.arrays_zip("sj", "sm", "ss"))).toDF("j", "m", "s")
    member = cut(clusters(keys, sets))
    # the pids of a cluster of several keys, each once
    size = narrowed(texts.select("p", F.explode("ks").alias("k")), member, "k").join(member, "k").select("cluster", "p").distinct().groupBy("cluster").agg(F.count(F.lit(1)).alias("c"))
    sized = (
        counts.join(member, "k", "left").where((F.col("line_pids") >= least) | F.col("cluster").isNotNull()).withColumn("cluster", F.coalesce("cluster", "k")).join(size, "cluster", "left")
        .withColumn("cluster_pids", F.coalesce("c", "line_pids")).where(F.col("cluster_pids") >= least).join(total, "j")
    )
    kept = sized.where(often("cluster_pids"))
    if exact:
        kept = kept.where(often("line_pids"))
    kept = cut(kept.select("k", "cluster", "cluster_pids", "line_pids"))
    return _occurrences(texts, kept, key)


def _occurrences(texts: DataFrame, kept: DataFrame, key: str) -> DataFrame:
    occurs = texts.select(F.col("t").alias(key), F.inline(F.arrays_zip("ns", "ks"))).select(key, F.col("ns").alias("line_no"), F.col("ks").alias("k"))
    return narrowed(occurs, kept, "k").join(kept, "k").drop("k")


def _totals(df: DataFrame, pid: str) -> DataFrame:
    """(j, pids): the distinct pids of each journal, texts or not, by the journal's hash."""
    sites = df.where(F.col(pid).isNotNull()).select(pid).distinct().groupBy(journal(F.col(pid)).alias("site")).agg(F.count(F.lit(1)).alias("pids"))
    return scan(sites.select("site", "pids"), "j bigint, pids bigint", lambda it: ((signed(xxhash.xxh64_intdigest(x)), n) for x, n in it))


def without_lines(df: DataFrame, found: DataFrame, key: str = "task_id", text: str = "text") -> DataFrame:
    """(key, clean, removed): each text without its found lines; a null text stays null, a task without found lines keeps its text."""
    gone = found.groupBy(key).agg(F.collect_set("line_no").alias("gone"))
    kept = F.filter(F.split(text, "\n"), lambda x, i: ~F.array_contains(F.coalesce("gone", F.array().cast("array<int>")), (i + 1).cast("int")))
    return df.select(key, text).join(gone, key, "left").select(key, F.array_join(kept, "\n").alias("clean"), F.coalesce(F.size("gone"), F.lit(0)).cast("int").alias("removed"))
