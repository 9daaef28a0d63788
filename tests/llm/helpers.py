"""Tables with every awkward case, for all operators."""

import zlib

import xxhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def awkward(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, columns with clashing names."""
    long_text = " ".join(f"word{i % 977} goes on." for i in range(30_000))
    rows = [
        (1, "Plain text that says little, in ten words or more, truly.", "en", "a", 10),
        (1, "Plain text that says little, in ten words or more, truly.", "en", "a", 10),
        (2, None, None, None, None),
        (3, "", "en", "a", 0),
        (4, " \t\n ", "de", "b", 4),
        (5, long_text, "en", "b", len(long_text)),
        (None, "No id here, but words enough to be kept by most rules at least.", "fr", "c", 3),
        (6, "Plain text that says little, in ten words or more, truly.", None, "c", 10),
        (7, "12 !! ;; 👍 ñ é", "es", "a", 1),
    ]
    df = spark.createDataFrame(rows, DOCS)
    more = ["key", "KIND", "label", "rate", "size", "copies", "row", "fp", "__hit", "n_words", "score", "toxic"]
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(more)]), rows


def empty(spark):
    return spark.createDataFrame([], DOCS)


def out_of_fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def brute_fingerprint(text, shingle=4):
    words = [w for w in (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius=4):
    """Smallest id each fingerprint reaches; prints: list of (doc_id, fingerprint)."""
    fps = sorted({f for _, f in prints})
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if (a ^ b).bit_count() <= radius:
                root[find(b)] = find(a)
    least = {}
    for d, f in prints:
        if d is not None:
            least[find(f)] = min(least.get(find(f), d), d)
    return [(d, f, least.get(find(f))) for d, f in prints]
