"""Best-fit packing into sequences of several permitted lengths.

Documents longer than the longest permitted length are cut into pieces of that length and a rest, so nothing is
lost. Pieces are dealt into shards of a bounded number (``shard_items``), which tasks pack independently:

* Pieces come in falling size. Each goes where it leaves the least room; if it fits nowhere, a bin is opened.
* Which size to open is optimised jointly over the permitted lengths: for every length L, a packing that opens
  bins of at least L (the smallest permitted length above the piece, if that is longer) is tried; so is the one
  that opens the length of least cost a token among those that hold the piece.
* Each bin is downsized to the smallest permitted length that holds its contents, and of these packings the one of
  least total cost is taken (the earlier on a tie).

The cost of a length is its tokens plus a share that grows with its square, as attention does.

Edge cases: documents without a word (null, empty or blank texts) give one row with a null bin; sizes are whole
words; a null doc_id is packed like any other; repeated rows are packed once each; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, word_count

LENGTHS, SHARD_ITEMS = (512, 1024, 2048, 4096, 8192), 4_096
#: Length at which the quadratic share equals the tokens.
QUADRATIC = 65_536
SCHEMA = "doc_id long, piece int, start long, n_words long, bin string, capacity int, offset int"


def cost(length: int) -> float:
    return length * (1 + length / QUADRATIC)


def best_fit(sizes: Sequence[int], lengths: Sequence[int], least: int | None) -> tuple[list[int], list[int], list[int], float]:
    """Bins of the items (in falling size), offsets within them, final lengths of the bins, and their total cost.

    ``least`` is the length to open at least; None opens the length of least cost a token. Bins wait in lists by
    free room, and the bits of one integer say which lists hold any, so the tightest fit is one shift away.
    """
    room: list[list[int]] = [[] for _ in range(lengths[-1] + 1)]
    free, bins, offsets, used, opened = 0, [], [], [], []
    for n in sizes:
        if fits := free >> n:
            r = n + (fits & -fits).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                free ^= 1 << r
        else:
            hold = [x for x in lengths if x >= n]
            r = min(hold, key=lambda x: (cost(x) / x, x)) if least is None else next((x for x in hold if x >= least), hold[-1])
            b = len(used)
            used.append(0)
            opened.append(r)
        bins.append(b)
        offsets.append(used[b])
        used[b] += n
        if r - n:
            if not room[r - n]:
                free |= 1 << (r - n)
            room[r - n].append(b)
    final = [next(x for x in lengths if x >= u) for u in used]
    return bins, offsets, final, sum(map(cost, final))


def pack_shard(sizes: np.ndarray, lengths: Sequence[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin, offset and final length of each item, by the cheapest of the joint trials."""
    order = np.argsort(-sizes, kind="stable")
    falling = sizes[order].tolist()
    bins, offsets, final, _ = min((best_fit(falling, lengths, least) for least in (None, *lengths)), key=lambda x: x[3])
    out = np.empty((3, len(sizes)), np.int64)
    out[:, order] = bins, offsets, np.array(final, np.int64)[bins]
    return out[0], out[1], out[2]


def pieces(docs: DataFrame, longest: int) -> DataFrame:
    """doc_id, piece, start and n_words of every piece; documents without a word have one piece of size 0."""
    n = word_count(F.col("text"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), n.alias("n"))
    cut = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.col("n") / longest) - 1).cast("int"))
    rows = rows.withColumn("piece", F.explode(cut)).withColumn("start", F.col("piece").cast("long") * longest)
    return rows.select("doc_id", "piece", "start", F.least(F.lit(longest), F.col("n") - F.col("start")).cast("long").alias("n_words"))


def pack(docs: DataFrame, lengths: Sequence[int] = LENGTHS, shard_items: int = SHARD_ITEMS) -> DataFrame:
    """Rows of SCHEMA: each piece's words [start, start + n_words) of its document, and its place [offset, ...) in a
    bin of the given capacity."""
    lengths = sorted(lengths)
    items = materialize(pieces(docs, lengths[-1]).withColumn("row", F.monotonically_increasing_id()), "packing-pieces")
    some = items.filter("n_words > 0")
    shards = max(1, -(-some.count() // shard_items))
    dealt = some.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "row"), F.lit(shards)))

    def run(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["n_words", "doc_id", "piece", "row"], ascending=[False, True, True, True], kind="stable")
        bins, offsets, final = pack_shard(g["n_words"].to_numpy(np.int64), lengths)
        return pd.DataFrame({"doc_id": g["doc_id"], "piece": g["piece"], "start": g["start"], "n_words": g["n_words"], "bin": [f"{key[0]}-{b}" for b in bins], "capacity": final, "offset": offsets})

    packed = dealt.groupBy("shard").applyInPandas(run, SCHEMA)
    none = items.filter("n_words = 0").select("doc_id", "piece", "start", "n_words", F.lit(None).cast("string").alias("bin"), F.lit(None).cast("int").alias("capacity"), F.lit(None).cast("int").alias("offset"))
    return packed.unionByName(none)
