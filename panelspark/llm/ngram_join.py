"""N-gram Jaccard join with prefix filters under several global token orders.

A document is the set of hashes of its distinct word shingles. Two sets link
when ``100 * intersection >= percent * union``. Under any total order of the
tokens, linked sets share a token among the first n - ceil(percent * n / 100) + 1
of each: the prefixes. A pair is verified only if its prefixes meet under every
one of several orders; all orders put rare tokens first and break ties by
different hashes.

Steps, none of which pairs up the members of a group:

1. One pass gives every set's size, a 128-bit signature, and counts of
   tokens. The counts (all documents; tokens seen fewer than ``LOCAL_COUNT``
   times in a task's buffer are left out) only decide the orders, which are right
   whatever they are: the ``RANKED`` most frequent tokens are sent to the
   executors, all others come before them. Equal sets become one node.
2. Prefix tokens under the first order are brought together, frequent ones
   salted, and tokens of a single document dropped.
3. Every node is a candidate with the smallest node of each of its tokens: a
   number of pairs that is linear in the prefixes. What passes the filters is
   verified, and linked nodes get a component. That settles groups of copies,
   however large.
4. Pairs of different components are the candidates that are left. They are taken
   from the first token they share only: one that stands early enough in both
   prefixes (``_may_be_first``) and has no common token among the ``EARLIER`` ones
   before it. They pass the same filters and are verified. No link between
   different components is lost, and those inside one change nothing.

Filters before verification: sizes; the number of prefix tokens shared under the
first order (``_enough``); common prefix tokens under the other orders. The sets are
read from the texts again, for the documents of remaining pairs only.

Shingles are 64-bit hashes, equality of sets is that of 128-bit signatures.

Defined results: a null text or one without a word has an empty set and links
with nothing; fewer words than a shingle are one shingle; rows of one id are one
document; rows with a null id are not linked and have a null component; an empty
table gives an empty result; extra columns are kept in one struct.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm.common import connected_components, saved, stored

SHINGLE, PERCENT = 4, 85
#: Seeds of the orders; the first one makes the candidates.
ORDERS = (11, 22, 33)
#: Tokens whose frequency the orders know, and the least count in a buffer of that many tokens.
RANKED, LOCAL_COUNT, BUFFER = 1 << 18, 3, 2 << 20
#: Parts that a frequent token's rows are dealt to.
SALTS = 64
#: Tokens before one that tell whether a pair has met already; any number is right.
EARLIER = 4
#: Size of the table that picks the texts to read again.
FILTER_BITS = 1 << 25
_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def mixed(x: np.ndarray, seed: int) -> np.ndarray:
    """A permutation of the 64-bit numbers that depends on ``seed``."""
    x = x ^ np.uint64(seed * int(_M[3]) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, size: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text."""
    words = text.encode().lower().split()  # of bytes: only A-Z change, only ASCII white space splits
    if not words:
        return np.zeros(0, dtype=np.uint64)
    one = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(size, len(one))
    total = np.full(len(one) - width + 1, width, dtype=np.uint64)
    for i in range(width):
        total = mixed(total * _M[0] + one[i : len(one) - width + 1 + i], i + 1)
    return np.unique(total)


def prefix_size(n: int, percent: int) -> int:
    return n + 1 - -(-percent * n // 100)


class Orders:
    """Total orders of tokens: by the known frequency class, then by a hash."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray):
        at = np.argsort(tokens)
        self.tokens = tokens[at]
        self.classes = np.minimum(255, 1 + 8 * np.log2(np.maximum(counts[at], 1))).astype(np.uint64)

    def frequent(self, tokens: np.ndarray) -> np.ndarray:
        """Class of each token, 0 for those that are not known."""
        if not len(self.tokens):
            return np.zeros(len(tokens), dtype=np.uint64)
        at = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
        return np.where(self.tokens[at] == tokens, self.classes[at], np.uint64(0))

    def prefix(self, tokens: np.ndarray, seed: int, percent: int, classes: np.ndarray | None = None) -> np.ndarray:
        """The first tokens of the set, in order."""
        size = prefix_size(len(tokens), percent)
        classes = self.frequent(tokens) if classes is None else classes
        place = classes << np.uint64(56) | mixed(tokens, seed) >> np.uint64(8)
        first = np.argpartition(place, size - 1)[:size] if size < len(tokens) else np.arange(len(tokens))
        return tokens[first[np.argsort(place[first])]]


def _signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


_PROFILE = "token long, n long, doc_id long, s1 long, s2 long"


def _profile(size: int):
    """Rows of two kinds: (token, n) of tokens counted in a buffer; (n, doc_id, s1, s2) of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        count = 0

        def counted() -> pa.RecordBatch:
            tokens = np.concatenate(held)
            held.clear()
            tokens.sort()
            first = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
            n = np.diff(first, append=len(tokens))
            often = n >= LOCAL_COUNT
            rows = int(often.sum())
            return pa.RecordBatch.from_arrays(
                [pa.array(_signed(tokens[first[often]])), pa.array(n[often]), *[pa.nulls(rows, pa.int64())] * 3],
                names=["token", "n", "doc_id", "s1", "s2"],
            )

        for batch in batches:
            texts = batch.column(1)
            n, s1, s2 = [], [], []
            for i in range(batch.num_rows):
                tokens = shingles(texts[i].as_py() or "", size)
                n.append(len(tokens))
                s1.append(int(_signed(np.asarray([mixed(tokens, 5).sum(dtype=np.uint64)]))[0]))
                s2.append(int(_signed(np.asarray([mixed(tokens, 6).sum(dtype=np.uint64)]))[0]))
                held.append(tokens)
                count += len(tokens)
                if count >= BUFFER:
                    yield counted()
                    count = 0
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(n), pa.int64()), pa.array(n, pa.int64()), batch.column(0), pa.array(s1, pa.int64()),
                 pa.array(s2, pa.int64())],
                names=["token", "n", "doc_id", "s1", "s2"],
            )
        if held:
            yield counted()

    return run


def _prefixes(orders, size: int, percent: int):
    """(doc_id, token, frequent, place) of the prefixes under the first order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            names, tokens, classes, places, held = [], [], [], [], 0

            def table() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(names)), pa.array(_signed(np.concatenate(tokens))),
                     pa.array(np.concatenate(classes) > 0), pa.array(np.concatenate(places))],
                    names=["doc_id", "token", "frequent", "place"],
                )

            for i, doc_id in enumerate(ids):
                found = shingles(texts[i].as_py() or "", size)
                if doc_id is None or not len(found):
                    continue
                first = orders.value.prefix(found, ORDERS[0], percent)
                tokens.append(first)
                classes.append(orders.value.frequent(first))
                names.append(np.full(len(first), doc_id, dtype=np.int64))
                places.append(np.arange(len(first), dtype=np.int32))
                held += len(first)
                if held > 1 << 17:
                    yield table()
                    names, tokens, classes, places, held = [], [], [], [], 0
            if tokens:
                yield table()

    return run


def _sets(orders, size: int, percent: int):
    """(node, tokens, p1, p2, ...): whole sets and their prefixes under the other orders."""
    names = [f"p{i}" for i in range(1, len(ORDERS))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                found = shingles(batch.column(1)[i].as_py() or "", size)
                classes = orders.value.frequent(found)
                lists = [found, *[orders.value.prefix(found, seed, percent, classes) for seed in ORDERS[1:]]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1), *[pa.array([_signed(x)], pa.list_(pa.int64())) for x in lists]],
                    names=["node", "tokens", *names],
                )

    return run, "node long, tokens array<long>, " + ", ".join(f"{n} array<long>" for n in names)


def _sizes_fit(percent: int) -> Column:
    return F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent


def _needed(percent: int) -> Column:
    """Tokens that two sets of these sizes must share to link."""
    return F.ceil((F.col("n_a") + F.col("n_b")) * percent / (100 + percent))


def _may_be_first(percent: int) -> Column:
    """Whether a shared token, ``p_a`` and ``p_b`` tokens being before it, leaves room for the others.

    Of a pair that links, the row of its first shared token passes.
    """
    return F.least(F.col("n_a") - F.col("p_a"), F.col("n_b") - F.col("p_b")) >= _needed(percent)


def _enough(percent: int) -> Column:
    """Whether ``shared`` prefix tokens under the first order are enough for a link.

    Of two sets, let x be the one whose prefix ends first in the order. All common tokens up to that
    end are in both prefixes; the others are among the tokens of x behind its prefix. So the
    intersection is at most the number of shared prefix tokens plus the longer of both rests.
    """
    least = lambda n: F.ceil(n * percent / 100)
    rest = F.greatest(least(F.col("n_a")), least(F.col("n_b"))) - 1
    return F.col("shared") + rest >= _needed(percent)


def _among(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id is in ``ids`` (column id of both).

    The semi join would shuffle every text, so texts are dropped before it by a
    table of ``FILTER_BITS`` bits, one set for the hash of each wanted id. Its
    size is the same for any number of ids; one that is too full only lets more texts through.
    It is looked up by a join: a Python function here would need one more Python worker a task.
    """
    place = F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS))
    words = (
        ids.select(place.alias("p"))
        .groupBy(F.expr("p div 64").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("bits"))
    )  # at most FILTER_BITS / 64 rows
    near = (
        docs.where(F.col("id").isNotNull()).withColumn("at", place).withColumn("word", F.expr("at div 64"))
        .join(F.broadcast(words), "word")
        .where(F.expr("shiftright(bits, cast(at % 64 as int)) & 1L") == 1)
        .drop("at", "word", "bits")
    )
    return near.join(ids, "id", "left_semi")


def _verified(pairs: DataFrame, docs: DataFrame, orders, size: int, percent: int) -> DataFrame:
    """Pairs that share a prefix token under every order and do link."""
    run, schema = _sets(orders, size, percent)
    needed = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    sets = stored(_among(docs, needed).select("id", "body").mapInArrow(run, schema), "shingle-sets")
    side = lambda x: sets.select(*[F.col(c).alias(x if c == "node" else f"{c}_{x}") for c in sets.columns])
    meet = [F.arrays_overlap(f"p{i}_a", f"p{i}_b") for i in range(1, len(ORDERS))]
    shared = F.size(F.array_intersect("tokens_a", "tokens_b"))
    union = F.size("tokens_a") + F.size("tokens_b") - F.col("shared")
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    for m in meet:
        both = both.where(m)
    return saved(
        both.withColumn("shared", shared).where(F.col("shared") * 100 >= union * percent).select("a", "b").distinct()
    )


def jaccard_components(
    docs: DataFrame,
    *,
    keep: Sequence[str] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
) -> DataFrame:
    """(doc struct, n_shingles, component_id) of every document.

    ``component_id`` is the smallest id reachable by links, the own one included.
    """
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("body"))
    profile = stored(own.mapInArrow(_profile(shingle), _PROFILE), "shingle-profiles")
    top = (
        profile.where("token is not null").groupBy("token").agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "token").limit(RANKED).toArrow()
    )  # at most RANKED rows
    orders = docs.sparkSession.sparkContext.broadcast(
        Orders(top.column("token").to_numpy().view(np.uint64), top.column("n").to_numpy())
    )

    sized = profile.where("token is null and doc_id is not null and n > 0").select("doc_id", "n", "s1", "s2")
    classes = sized.groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("node"))
    members = stored(sized.join(classes, ["s1", "s2", "n"]).select("doc_id", "node", "n").distinct(), "shingle-members")

    salted = F.when(F.col("frequent"), F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))).otherwise(F.lit(0))
    together = Window.partitionBy("token", "salt")
    rows = own.mapInArrow(_prefixes(orders, shingle, percent), "doc_id long, token long, frequent boolean, place int")
    shared = stored(
        rows.withColumn("salt", salted)
        .withColumn("several", F.min("doc_id").over(together) < F.max("doc_id").over(together))
        .where("several or frequent")
        .select("token", "doc_id", "place"),
        "prefix-tokens",
    )
    buckets = stored(shared.join(members, "doc_id").select("token", "node", "n", "place").distinct(), "prefix-buckets")

    least = buckets.groupBy("token").agg(
        F.min_by(F.struct(F.col("node").alias("a"), F.col("n").alias("n_a")), "node").alias("first"),
        F.max("node").alias("z"),
    ).where("first.a < z")
    near = buckets.join(least.select("token", "first.*"), "token").where("node > a")
    met = near.select("a", "n_a", F.col("node").alias("b"), F.col("n").alias("n_b")).where(_sizes_fit(percent))
    stars = stored(
        met.groupBy("a", "b", "n_a", "n_b").agg(F.count("*").alias("shared")).where(_enough(percent)).select("a", "b"),
        "star-pairs",
    )
    links = _verified(stars, own, orders, shingle, percent)

    settled = saved(connected_components(links))
    placed = buckets.join(settled, "node", "left").select(
        "token", "node", "n", "place", F.coalesce("component", "node").alias("component")
    )
    mixed_tokens = (
        placed.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low < high").select("token")
    )
    order = Window.partitionBy("node").orderBy("place")
    earlier = F.array_compact(F.array(*[F.lag("token", i).over(order) for i in range(1, EARLIER + 1)]))
    open_rows = saved(placed.join(mixed_tokens, "token", "left_semi").withColumn("earlier", earlier))
    side = lambda x: open_rows.select(
        "token", F.col("node").alias(x),
        *[F.col(c).alias(f"{c[0]}_{x}") for c in ("n", "place", "component", "earlier")],
    )
    others = (F.col("a") < F.col("b")) & (F.col("c_a") != F.col("c_b")) & ~F.arrays_overlap("e_a", "e_b")
    met = side("a").join(side("b"), "token").where(others & _sizes_fit(percent) & _may_be_first(percent))
    candidates = stored(met.select("a", "b").distinct().join(stars, ["a", "b"], "left_anti"), "front-pairs")
    # the open prefix tokens of a node in one row: a pair stays one row while its common ones are counted
    lists = saved(open_rows.groupBy("node", "n").agg(F.collect_list("token").alias("tokens")))
    held = lambda x: lists.select(*[F.col(c).alias(x if c == "node" else f"{c}_{x}") for c in lists.columns])
    counted = candidates.join(held("a"), "a").join(held("b"), "b").withColumn(
        "shared", F.size(F.array_intersect("tokens_a", "tokens_b"))
    )
    remaining = stored(counted.where(_enough(percent)).select("a", "b"), "other-pairs")
    more = _verified(remaining, own, orders, shingle, percent)

    final = connected_components(
        settled.select(F.col("node").alias("a"), F.col("component").alias("b"))
        .unionByName(members.select(F.col("doc_id").alias("a"), F.col("node").alias("b")).where("a <> b"))
        .unionByName(more)
    )
    sizes = profile.where("token is null").select("doc_id", "n").groupBy("doc_id").agg(F.max("n").alias("n_shingles"))
    named = sizes.join(final.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left")
    kept = docs.select(F.struct(*[F.col(f"`{c}`") for c in (keep or docs.columns)]).alias("doc"), F.col(id_col).alias("id"))
    found = named.select(
        F.col("doc_id").alias("found_id"), "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )
    return kept.join(found, F.col("id").eqNullSafe(F.col("found_id")), "left").select("doc", "n_shingles", "component_id")
