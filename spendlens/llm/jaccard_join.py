"""N-gram Jaccard join by parity sketches.

A document's set holds its distinct ``n``-word shingles. Two sets of sizes a <= b with a Jaccard
similarity of at least ``PERCENT`` hundredths differ in at most (100 - PERCENT) (a + b) / (100 + PERCENT)
shingles and lie in one size band or in neighbouring ones. For each band a set's shingles are dealt to P words; a word is the
XOR of its shingles' hashes, so one different shingle changes at most one word. With D the greatest
difference allowed in a band and P = D + ``SHARED`` + s words, similar sets agree in at least s + ``SHARED`` words
(pigeonhole). Words are joined by value. A set leaves out its s words that say least: words without shingles, which are no keys,
then the most frequent ones, where few shingles count as frequent. Of the common words the ``SHARED`` that say most are left out by neither
set, so no similar pair is lost, while words made of boilerplate alone do not bring strangers
together. A set with more than s empty words also gets keys that decide alone: its words once more and each choice of s + ``SHARED`` empty ones.
A set that is far from its band's greatest size leaves out more, by the difference that its own size allows.

How frequent a word is tells a table of ``SLOTS`` counters over the words of all texts; words that say equally much are in order of
their value. That is one order of all words, so no pair is lost, and the words left out are never shuffled.

Keys with the same sets are one group. Two sets of groups of at most ``SMALL`` sets are candidates if they share ``SHARED`` keys, those of a larger group at once.
Candidates meet as sketches of parity words, where a shingle toggles one bit: the number of different bits is a lower bound of the difference. There are
some bits for each difference allowed (narrower sketches are folds of wider ones), and sizes and Hamming distances leave a spanning forest
of the pairs that may be similar; a group beyond ``GROUP`` sets meets in blocks. The connected components of these pairs are families: only their
texts are read once more. A family's sets meet in blocks of at most ``BLOCK_BYTES``, each pair of blocks in one task, where the
shingles themselves decide. A pair that verified links already connect needs no test, so the links that leave a task are a
spanning forest, not all pairs. Equal sets are one node from the start.

Edge cases: a text without words has an empty set, is linked with nothing and is its own component; with
fewer than ``n`` words the whole sequence is one shingle; null ids take part, and a component's id is its
least id that is not null; rows with one id stay separate rows; other columns are not read by the join.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import chunks, mix, nullable, ship, table, text_shingles, written, WordHashes
from .components import components

N, PERCENT = 4, 85
BLOCK_BYTES = 32 << 20
GROUP, SMALL, SHARED = 4096, 8, 3
KEY_BITS, MOST_OFTEN, LACKING = 53, 2047, 48
ALONE = np.uint64(1 << KEY_BITS)
SLICES, SLICE = 32, 1 << 16
SLOTS = SLICES * SLICE
MAX_BROADCAST = 1_000_000


def shingle_set(hashes: WordHashes, text: str | None, n: int = N) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; ``hashes`` is not needed any more."""
    return sets_of([text], n)[0]


def sets_of(texts: Iterable[str | None], n: int) -> tuple[np.ndarray, np.ndarray]:
    """(the sets of the texts, each sorted, laid end to end; their sizes)."""
    s, counts = text_shingles(texts, n)
    ends = np.cumsum(counts)
    for i, j in zip((ends - counts).tolist(), ends.tolist()):
        s[i:j].sort()
    new = np.r_[True, s[1:] != s[:-1]] if len(s) else np.zeros(0, bool)
    new[(ends - counts)[counts > 0]] = True
    held = np.r_[0, np.cumsum(new)]
    return s[new], held[ends] - held[ends - counts]


def node_of(s: np.ndarray) -> int:
    """Equal sets, equal nodes; an even signed 64-bit number."""
    return (xxhash.xxh64_intdigest(s.astype("<u8").tobytes(), 7) & ~1) - (1 << 63)


def nodes_of(s: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``node_of`` of sets laid end to end."""
    ends = np.cumsum(sizes)
    return np.array([node_of(s[i:j]) for i, j in zip((ends - sizes).tolist(), ends.tolist())], np.int64)


@lru_cache(maxsize=None)
def band_start(band: int, percent: int) -> int:
    """Sets of band k have band_start(k) to band_start(k + 1) - 1 shingles."""
    return 1 if band == 0 else band_start(band - 1, percent) * 100 // percent + 1


def band_of(size: int, percent: int) -> int:
    k = 0
    while band_start(k + 1, percent) <= size:
        k += 1
    return k


def most_different(a: int, b: int, percent: int) -> int:
    return (100 - percent) * (a + b) // (100 + percent)


@lru_cache(maxsize=None)
def words_in(band: int, percent: int) -> tuple[int, int]:
    """P and s of the table for pairs whose smaller set lies in the band; P is 0 if only equal sets are similar."""
    top = band_start(band + 1, percent) - 1
    d = most_different(top, top * 100 // percent, percent)
    if d == 0:
        return 0, 0
    return d + SHARED + d // 2, d // 2


@lru_cache(maxsize=None)
def plan(size: int, table_: int, percent: int) -> tuple[int, int, int, int]:
    """(band of the table, P, words of which a set of ``size`` may leave out its most frequent, zeros of which a choice is a key); P is 0 where the table has no keys."""
    band = band_of(size, percent) - 1 + table_ if size else -1
    words, spare = words_in(band, percent) if band >= 0 else (0, 0)
    if not words:
        return band, 0, 0, 0
    other = size * 100 // percent if table_ else band_start(band + 1, percent) - 1
    return band, words, words - SHARED - most_different(size, other, percent), SHARED + spare


def dealt_shingles(s: np.ndarray, sizes: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word, first shingle) of the words that hold shingles, for sets laid end to end, ``words`` of each; the words are numbered through.
    A shingle's high bits choose the word, so in a sorted set each word's shingles are adjacent."""
    each = np.repeat(words, sizes)
    at = (((s >> np.uint64(32)) * each.astype(np.uint64)) >> np.uint64(32)).astype(np.int64) + np.repeat(np.cumsum(words) - words, sizes)
    starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(s) else np.zeros(0, np.int64)
    return at[starts], starts


def sketches(s: np.ndarray, sizes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The parity words of many sets laid end to end: a shingle's low bits choose the bit of its word that it toggles."""
    out = np.zeros(int(words.sum()), np.uint64)
    at, starts = dealt_shingles(s, sizes, words)
    if len(s):
        out[at] = np.bitwise_xor.reduceat(np.uint64(1) << (s & np.uint64(63)), starts)
    return out


def sketch(s: np.ndarray, words: int) -> np.ndarray:
    """``sketches`` of one set."""
    return sketches(s, np.array([len(s)]), np.array([words]))


def table_keys(s: np.ndarray, sizes: np.ndarray, table_: int, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
    """Of sets laid end to end: (keys of a table; how many each set has; how many of the most frequent it leaves out; for sets whose zeros are
    more than those they may leave out, its number and the keys that decide alone)."""
    of = np.array([plan(k, table_, percent) for k in sizes.tolist()], np.int64).reshape(-1, 4)
    band, words, spare, chosen = of.T
    s = s[np.repeat(words > 0, sizes)]
    at, starts = dealt_shingles(s, np.where(words > 0, sizes, 0), words)
    held = np.diff(np.r_[starts, len(s)])
    behind = np.cumsum(words)
    which = np.searchsorted(behind, at, "right")
    w = np.bitwise_xor.reduceat(s, starts) if len(s) else s
    place = at - (behind - words)[which]
    k = mix(mix(w) + mix(place.astype(np.uint64) + (band[which].astype(np.uint64) << np.uint64(32)))) >> np.uint64(64 - KEY_BITS + 3)
    k |= np.minimum(held, 7).astype(np.uint64) << np.uint64(KEY_BITS - 3)
    counts = np.bincount(which, minlength=len(sizes))
    zeros = words - counts
    alone, ends = [], np.cumsum(counts)
    for i in np.flatnonzero(zeros > spare).tolist():
        none = np.setdiff1d(np.arange(words[i]), place[ends[i] - counts[i]:ends[i]])
        choices = [xxhash.xxh64_intdigest(np.array(c).astype("<u8").tobytes(), int(band[i])) >> 64 - KEY_BITS
                   for c in (combinations(none, int(chosen[i])) if len(none) >= chosen[i] else ())]
        alone.append((i, np.r_[k[ends[i] - counts[i]:ends[i]], np.array(choices, np.uint64)] | ALONE))
    return k, counts, np.maximum(0, spare - zeros), alone


def keys(s: np.ndarray, percent: int = PERCENT) -> list[tuple[int, int, np.ndarray]]:
    """(table: 1 of the set's own band or 0 of the one below, how many of the most frequent keys to leave out, keys)."""
    out = []
    for table_ in (1, 0):
        k, _, leave, alone = table_keys(s, np.array([len(s)]), table_, percent)
        if len(k):
            out.append((table_, int(leave[0]), k))
        out += [(2 + table_, 0, x) for _, x in alone]  # none of them may be left out
    return out


def slots_of(k: np.ndarray) -> np.ndarray:
    """The counter of each key."""
    return (k & np.uint64(SLOTS - 1)).astype(np.int64)


def rarest(k: np.ndarray, counts: np.ndarray, leave: np.ndarray, often: np.ndarray) -> np.ndarray:
    """Keys of sets laid end to end, without those that each set leaves out: the ones of the fullest counters, where each shingle that a word
    lacks of 7 counts as ``LACKING``; of equal ones the least."""
    full = np.minimum(often[slots_of(k)] + LACKING * (7 - (k >> np.uint64(KEY_BITS - 3)).astype(np.int64)), MOST_OFTEN)
    order = (MOST_OFTEN - full).astype(np.uint64) << np.uint64(KEY_BITS) | k
    ends = np.cumsum(counts)
    for i, j in zip((ends - counts).tolist(), ends.tolist()):
        order[i:j].sort()
    stays = np.arange(len(k)) >= np.repeat(ends - counts + leave, counts)
    return order[stays] & np.uint64((1 << KEY_BITS) - 1)


def kept_keys(s: np.ndarray, percent: int, often: np.ndarray) -> list[np.ndarray]:
    """The set's keys (as ``keys``) without those that may be left out."""
    return [rarest(k, np.array([len(k)]), np.array([leave]), often) if t < 2 else k for t, leave, k in keys(s, percent)]


@lru_cache(maxsize=None)
def bit_words(size: int, percent: int) -> int:
    """Words of the sketch a set is compared by: a power of two, 4 bits or more for each difference allowed, which strangers pass by more than five deviations."""
    return 1 << max(2, (most_different(size, size, percent) // 16).bit_length())


def fold(bits: np.ndarray, words: int) -> np.ndarray:
    """The sketch of fewer words: neighbours are XORed until ``words`` are left."""
    while len(bits) > words:
        bits = bits[::2] ^ bits[1::2]
    return bits


def _key_rows(batches: Iterator[pd.DataFrame], n: int, percent: int, table_) -> Iterator[pd.DataFrame]:
    """Each set's keys. A node's lowest bit tells whether the key is of the table of its own band."""
    often = table_.value
    out, held, seen = [], 0, set()

    def frame() -> pd.DataFrame:
        node, key = (np.concatenate(x) for x in zip(*out))
        return pd.DataFrame({"node": node, "key": key.view(np.int64)})

    for b in batches:
        texts = b["text"].tolist()
        for x, y in chunks(texts):
            s, sizes = sets_of(texts[x:y], n)
            nodes, new = nodes_of(s, sizes), []
            if len(seen) > 1_000_000:
                seen.clear()
            for node, size in zip(nodes.tolist(), sizes.tolist()):  # copies in one task say the same
                new.append(size > 0 and node not in seen)
                seen.add(node)
            new = np.array(new, bool)
            s, nodes, sizes = s[np.repeat(new, sizes)], nodes[new], sizes[new]
            for t in (1, 0):
                k, counts, leave, alone = table_keys(s, sizes, t, percent)
                new = [(np.repeat(nodes | t, counts - np.minimum(leave, counts)), rarest(k, counts, leave, often)),
                       *((np.full(len(a), nodes[i] | t), a) for i, a in alone)]
                out += new
                held += sum(len(k) for _, k in new)
            if held > 200_000:
                yield frame()
                out, held = [], 0
    if out:
        yield frame()


def _node_rows(batches: Iterator[pd.DataFrame], n: int, percent: int) -> Iterator[pd.DataFrame]:
    """One row for each text, then the task's counters of keys, a row for each slice."""
    counts = np.zeros(SLOTS, np.uint32)
    for b in batches:
        size, node, bits = [], [], []
        texts = b["text"].tolist()
        for x, y in chunks(texts):
            s, sizes = sets_of(texts[x:y], n)
            for t in (1, 0):
                k, _, _, alone = table_keys(s, sizes, t, percent)
                for more in (k, *(a for _, a in alone)):
                    np.add.at(counts, slots_of(more), np.uint32(1))
            words = np.array([bit_words(k, percent) if k else 0 for k in sizes.tolist()], np.int64)
            sketched, ends = sketches(s, sizes, words).astype("<u8"), np.cumsum(words).tolist()
            size += sizes.tolist()
            node += [v if k else None for v, k in zip(nodes_of(s, sizes).tolist(), sizes.tolist())]
            bits += [sketched[j - w:j].tobytes() if w else None for j, w in zip(ends, words.tolist())]
        # never by way of floats, which would round the hashes of a batch that holds a null
        none = pd.arrays.IntegerArray(np.zeros(len(b), np.int32), np.ones(len(b), bool))
        yield pd.DataFrame({"id": b["id"], "n_shingles": size, "node": nullable(node), "slice": none, "bits": bits})
    null = nullable([None])
    for k in range(SLICES if counts.any() else 0):
        packed = counts[k * SLICE:(k + 1) * SLICE].astype("<u4").tobytes()
        yield pd.DataFrame({"id": null, "n_shingles": null, "node": null, "slice": np.array([k], np.int32), "bits": [packed]})


def _slice_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The sum of each slice, as 32nds of a binary order of magnitude."""
    sums: dict[int, np.ndarray] = {}
    for b in batches:
        for k, c in zip(b["slice"], b["bits"]):
            sums[k] = sums.get(k, np.zeros(SLICE, np.int64)) + np.frombuffer(c, "<u4")
    code = [np.minimum(32 * np.log2(1 + v), MOST_OFTEN).astype("<u2").tobytes() for v in sums.values()]
    yield pd.DataFrame({"slice": np.array(list(sums), np.int32), "code": code})


def frequency(counts: DataFrame) -> np.ndarray:
    """How frequent the keys of each counter are (2 * SLOTS bytes, 4 MiB, whatever the size of the input)."""
    often = np.zeros((SLICES, SLICE), np.uint16)
    for r in counts.repartition("slice").mapInPandas(_slice_sums, "slice int, code binary").collect():
        often[r["slice"]] = np.frombuffer(r["code"], "<u2")
    return often.reshape(-1)


def near_forest(nodes: np.ndarray, sizes: np.ndarray, bits: list[bytes], sides: np.ndarray | None, percent: int) -> list[tuple[int, int]]:
    """Pairs that connect all pairs whose sizes and sketches allow them to be similar; with ``sides``, of those between two sides."""
    order = np.argsort(sizes, kind="stable")
    nodes, sizes = nodes[order], sizes[order]
    found = [np.frombuffer(bits[k], "<u8") for k in order]
    words = min(map(len, found))
    found = np.stack([fold(x, words) for x in found])
    side = sides[order] if sides is not None else None
    group, out = np.arange(len(order)), []
    for i in range(1, len(order)):
        rows = np.flatnonzero((group[:i] != group[i]) & (100 * sizes[:i] >= percent * sizes[i]))
        if side is not None:
            rows = rows[side[rows] != side[i]]
        if len(rows) == 0:
            continue
        far = np.bitwise_count(found[rows] ^ found[i]).sum(axis=1)
        for j in rows[far * (100 + percent) <= (100 - percent) * (sizes[rows] + sizes[i])]:
            if group[j] != group[i]:
                out.append((int(nodes[i]), int(nodes[j])))
                group[group == group[j]] = group[i]
    return out


def _near_rows(batches: Iterator[pd.DataFrame], percent: int) -> Iterator[pd.DataFrame]:
    """``near_forest`` of each run of equal (sig, i, j); rows come sorted, a run may span batches."""
    held = None

    def pairs(b: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        node, size, bits = b["node"].to_numpy(), b["size"].to_numpy(), b["bits"].tolist()
        i, j, block = b["i"].to_numpy(), b["j"].to_numpy(), b["block"].to_numpy()
        out = []
        for x, y in zip(starts, [*starts[1:], len(b)]):
            if y - x > 1:
                out += near_forest(node[x:y], size[x:y], bits[x:y], None if i[x] == j[x] else block[x:y] == j[x], percent)
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    for b in batches:
        if held is not None:
            b = pd.concat([held, b], ignore_index=True)
        at = b[["sig", "i", "j"]].to_numpy()
        starts = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]).any(axis=1)]) if len(b) else np.zeros(0, int)
        if len(starts) > 1:
            yield pairs(b.iloc[:starts[-1]], starts[:-1])
            b = b.iloc[starts[-1]:]
        held = b
    if held is not None and len(held):
        yield pairs(held, np.zeros(1, int))


def _set_rows(batches: Iterator[pd.DataFrame], n: int) -> Iterator[pd.DataFrame]:
    for b in batches:
        sets = [sets_of([t], n)[0] for t in b["text"]]
        right = [len(s) > 0 and node_of(s) == k for s, k in zip(sets, b["node"])]
        yield pd.DataFrame({"family": b["family"], "node": b["node"], "blocks": b["blocks"], "shingles": [s.astype("<u8").tobytes() for s in sets]})[right]


def linked(nodes: list[int], sets: list[np.ndarray], sides: list[int] | None, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the similar pairs; with ``sides``, of those between side 0 and side 1 only."""
    order = sorted(range(len(sets)), key=lambda k: len(sets[k]))
    sizes = np.array([len(sets[k]) for k in order])
    words = max(4, most_different(int(sizes[-1]), int(sizes[-1]), percent) // 8 + 1)
    bits = np.stack([sketch(sets[k], words) for k in order])
    side = np.array([sides[k] for k in order]) if sides else None
    group = np.arange(len(order))
    out = []
    first = 0
    for i in range(1, len(order)):
        while 100 * sizes[first] < percent * sizes[i]:
            first += 1
        rows = np.arange(first, i)
        rows = rows[group[rows] != group[i]]
        if side is not None:
            rows = rows[side[rows] != side[i]]
        if len(rows) == 0:
            continue
        far = np.bitwise_count(bits[rows] ^ bits[i]).sum(axis=1)
        near = far * (100 + percent) <= (100 - percent) * (sizes[rows] + sizes[i])
        for j in rows[near][np.argsort(far[near], kind="stable")]:
            if group[j] == group[i]:
                continue
            both = len(np.intersect1d(sets[order[j]], sets[order[i]], assume_unique=True))
            if 100 * both >= percent * (sizes[i] + sizes[j] - both):
                out.append((nodes[order[i]], nodes[order[j]]))
                group[group == group[j]] = group[i]
    return out


def links(docs: DataFrame, rows: DataFrame, often: np.ndarray, key: str, text: str, n: int = N, percent: int = PERCENT) -> DataFrame:
    """(a, b): verified links between nodes that connect exactly what similar pairs connect."""
    table_ = docs.sparkSession.sparkContext.broadcast(often)
    found = docs.select(F.col(text).alias("text")).mapInPandas(lambda it: _key_rows(it, n, percent, table_), "node long, key long")
    # of keys that several sets hold, one of them in the table of its own band, those with the same sets are one group
    # the window's functions take bare columns, so nothing else is shuffled
    of_key, one = Window.partitionBy("key"), F.lit(1)
    own = F.col("node").bitwiseAND(one)
    shared = found.select("node", "key", F.min("node").over(of_key).alias("least"), F.max("node").over(of_key).alias("most"),
                          F.bit_or("node").over(of_key).alias("any"), F.bit_xor("node").over(of_key).alias("all"), F.count("*").over(of_key).alias("rows"))
    shared = shared.where((F.col("least") < F.col("most") - F.col("most").bitwiseAND(one)) & (F.col("any").bitwiseAND(one) == 1))
    groups = shared.select(F.xxhash64("rows", "all", "least").alias("sig"), (F.col("node") - own).alias("node"), own.alias("own"), "key").groupBy("sig", "node", "own").agg(
        F.sum(F.when(F.col("key") >= F.lit(int(ALONE)), SHARED).otherwise(1)).alias("said"))
    groups = written(groups, "jaccard-groups").withColumn("held", F.count("*").over(Window.partitionBy("sig")))
    # sets of small groups are compared if they share keys enough, all of a larger one are
    later = lambda v: F.filter("sets", lambda u: (u["node"] > v["node"]) & (u["own"] + v["own"] > 0))
    few_sets = groups.where(F.col("held") <= SMALL).groupBy("sig").agg(F.collect_list(F.struct("node", "own", "said")).alias("sets"))
    pairs = few_sets.select(F.explode(F.flatten(F.transform("sets", lambda v: F.transform(later(v), lambda u: F.struct(
        v["node"].alias("a"), u["node"].alias("b"), F.least(v["said"], u["said"]).alias("said")))))).alias("p")).select("p.*")
    pairs = pairs.groupBy("a", "b").agg(F.sum("said").alias("said")).where(F.col("said") >= SHARED)
    alone = pairs.select(F.xxhash64("a", "b").alias("sig"), F.explode(F.array("a", "b")).alias("node"), F.lit(1).alias("blocks"))
    large = groups.where(F.col("held") > SMALL).select("sig", "node", F.ceil(F.col("held") / GROUP).cast("int").alias("blocks")).distinct()
    nodes = rows.where("node is not null").groupBy("node").agg(F.min("id").alias("id"), F.first("n_shingles").alias("size"), F.first("bits").alias("bits"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    mates = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(
        F.least(block, o).alias("i"), F.greatest(block, o).alias("j")))
    dealt = alone.unionByName(large).select("sig", "node", block.alias("block"), F.explode(mates).alias("m"))
    dealt = dealt.join(nodes.select("node", "size", "bits"), "node").select("sig", "m.i", "m.j", "block", "node", "size", "bits")
    near = dealt.repartition("sig", "i", "j").sortWithinPartitions("sig", "i", "j").mapInPandas(lambda it: _near_rows(it, percent), "a long, b long")
    families = components(near, "a", "b").withColumnRenamed("component", "family")

    # the texts of the families' sets, in blocks
    members = families.join(nodes.select("node", "id", "size"), "node")
    sizes = members.groupBy("family").agg(F.ceil(F.sum("size") * 8 / F.lit(BLOCK_BYTES)).cast("int").alias("blocks"))
    members = written(members.join(sizes, "family").select("node", "family", "blocks", "id"), "jaccard-members")
    few = members.count() <= MAX_BROADCAST
    candidates = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text")).join(
        F.broadcast(members) if few else members, F.col("doc").eqNullSafe(F.col("id"))).select("family", "node", "blocks", "text")
    sets = candidates.mapInPandas(lambda it: _set_rows(it, n), "family long, node long, blocks int, shingles binary")
    dealt = sets.select("family", "node", "shingles", block.alias("block"), F.explode(mates).alias("m")).select("family", "m.i", "m.j", "block", "node", "shingles")

    def verify(block_pair: pd.DataFrame) -> pd.DataFrame:
        block_pair = block_pair.drop_duplicates("node")
        sets = [np.frombuffer(x, "<u8") for x in block_pair["shingles"]]
        i, j = block_pair["i"].iloc[0], block_pair["j"].iloc[0]
        sides = None if i == j else [int(x == j) for x in block_pair["block"]]
        return pd.DataFrame(linked(block_pair["node"].tolist(), sets, sides, percent), columns=["a", "b"], dtype="int64")

    return written(dealt.groupBy("family", "i", "j").applyInPandas(verify, "a long, b long"), "jaccard-links")


def classified(docs: DataFrame, key: str, text: str, n: int, percent: int) -> DataFrame:
    """(id, n_shingles, node, component_id) of each row; the node is null where the set is empty."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).mapInPandas(
        lambda it: _node_rows(it, n, percent), "id long, n_shingles long, node long, slice int, bits binary")
    rows = written(rows, "jaccard-nodes")
    often = frequency(rows.where("slice is not null").select("slice", "bits"))
    rows = rows.where("slice is null").select("id", "n_shingles", "node", "bits")
    pairs = links(docs, rows, often, key, text, n, percent)
    named = components(pairs, "a", "b")
    # of each different set the least id, then of each component
    least = rows.where("node is not null").groupBy("node").agg(F.min("id").alias("least"))
    least = least.join(named, "node", "left")
    of_component = least.where("component is not null").groupBy("component").agg(F.min("least").alias("component_least"))
    least = least.join(of_component, "component", "left").select(
        "node", F.coalesce("component", "node").alias("component"), F.coalesce("component_least", "least").alias("component_id"))
    return rows.select("id", "n_shingles", "node").join(least, "node", "left")


def similar_components(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = N, percent: int = PERCENT) -> DataFrame:
    """(key, n_shingles, component_id): the size of each row's set and its class."""
    out = classified(docs, key, text, n, percent)
    return out.select(F.col("id").alias(key), "n_shingles", F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))


def _node_column(n: int):
    @F.pandas_udf("long")
    def node(texts: pd.Series) -> pd.Series:
        sets = [sets_of([t], n)[0] for t in texts]
        return pd.Series(nullable([node_of(s) if len(s) else None for s in sets]))
    return node


def keep_representatives(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = N, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component of sets of ``n`` words, similar from ``percent`` hundredths on: the one of the least id (nulls last; of equal ids any one). All columns
    unchanged; rows without words are kept. Only rows whose id some lost row has are looked at again; the texts of the others are neither written nor moved."""
    classes = classified(docs, key, text, n, percent).where("node is not null").groupBy("component", "id", "node").agg(F.count("*").alias("rows"))
    best = classes.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "node")).alias("best"))
    best = best.select(F.col("component").alias("c"), "best.id", "best.node").select("c", F.col("id").alias("best_id"), F.col("node").alias("best_node"))
    stays = F.col("id").eqNullSafe(F.col("best_id")) & (F.col("node") == F.col("best_node"))
    touched = written(classes.join(best, F.col("component") == F.col("c")).withColumn("stays", stays).where("not stays or rows > 1")
                      .select("id", "node", "stays"), "jaccard-touched")
    losers, ids = touched.where("not stays").select("id", "node"), touched.select("id").distinct()
    if touched.count() <= MAX_BROADCAST:
        losers, ids = F.broadcast(losers), F.broadcast(ids)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{key}`").cast("long").alias("doc"))
    same = F.col("doc").eqNullSafe(F.col("id"))
    unlike = rows.join(ids, same, "left_anti").select("row")
    again = rows.join(ids, same, "left_semi").withColumn("kind", _node_column(n)(F.col("row")[text]))
    again = again.join(losers, same & F.col("kind").eqNullSafe(F.col("node")), "left_anti")
    empty = again.where("kind is null").select("row")
    one = again.where("kind is not null").groupBy("doc", "kind").agg(F.first("row").alias("row")).select("row")
    return unlike.unionByName(empty).unionByName(one).select("row.*")


def op4_jaccard(spark, sf_dir: str) -> DataFrame:
    return similar_components(table(spark, sf_dir, "documents"))


# shingles as hashes of their words; similar pairs by a count of shared shingles; components by a closure over the links
ORACLE = f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, hash(array_to_string(list_slice(w, i, i + {N - 1}), ' ')) AS h
      FROM d, unnest(range(1, greatest(len(w) - {N - 1}, 1) + 1)) AS t(i) WHERE len(w) > 0),
z AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s AS a JOIN s AS b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN z AS x ON x.doc_id = a JOIN z AS y ON y.doc_id = b WHERE 100 * shared >= {PERCENT} * (x.n + y.n - shared)),
r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS m FROM r GROUP BY a)
SELECT d.doc_id, CAST(coalesce(z.n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(c.m, d.doc_id)) AS component_id
FROM d LEFT JOIN z ON z.doc_id = d.doc_id LEFT JOIN c ON c.a = d.doc_id"""
