"""Token counts as delta-maintained rollups.

Totals by source, language and tokenizer version are kept as a table of
signed deltas: an insert adds a document's counts, a delete takes them away, a
revision takes the old and adds the new. A batch of changes is reduced to one
delta row for each key (before the shuffle in its tasks, so a source with a
third of all rows is a few rows) and committed under its batch id by
overwriting that batch's own folder: a batch that is sent again replaces
itself, and one that failed half-way leaves no committed rows. Totals are the
sum over committed batches; ``compact`` folds old ones into a snapshot.

Defined cases: null source, language or tokenizer is a key like any other; a
null text has no tokens but counts as a document. A change with an unknown
``op`` is refused. Repeated rows in one batch each count. A key whose
documents are all gone stays out of the totals. Extra columns are not read;
an empty batch commits nothing and an empty table has no totals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.llm import bpe
from ferry.llm.common import checkpointed, map_rows, table
from ferry.session import fresh_dir

KEYS = ("source", "lang", "tokenizer")
MEASURES = ("n_docs", "n_tokens", "n_chars")
CHANGES = "op string, source string, lang string, tokenizer string, old_tokens long, old_chars long, new_tokens long, new_chars long"
_DELTAS = "source string, lang string, tokenizer string, n_docs long, n_tokens long, n_chars long"
# The tokenizer versions that documents are counted by.
WORDS = "words-1"
BYTES = "byte_bpe_50k"


def deltas(changes: DataFrame) -> DataFrame:
    """One signed row for each key of a batch of CHANGES."""
    op = F.col("op")
    known = F.when(op.isin("insert", "delete", "revise"), op).otherwise(
        F.raise_error(F.concat(F.lit("unknown change: "), F.coalesce(op, F.lit("null"))))
    )
    old = F.when(known != "insert", 1).otherwise(0).cast("long")
    new = F.when(known != "delete", 1).otherwise(0).cast("long")
    zero = F.lit(0).cast("long")
    signed = changes.select(
        *KEYS,
        (new - old).alias("n_docs"),
        *[
            (new * F.coalesce(f"new_{m}", zero) - old * F.coalesce(f"old_{m}", zero)).alias(f"n_{m}")
            for m in ("tokens", "chars")
        ],
    )
    return signed.groupBy(*KEYS).agg(*[F.sum(m).alias(m) for m in MEASURES])


class Rollup:
    """Totals under a folder in the cluster's shared storage."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def commit(self, batch_id: int, changes: DataFrame) -> None:
        """Apply a batch; the same batch again leaves the totals as they are.

        The job's own commit puts the folder in place as a whole: a retried
        task or job writes the same rows.
        """
        deltas(changes).write.mode("overwrite").parquet(f"{self.folder}/batch={int(batch_id)}")

    def batches(self) -> DataFrame:
        """Delta rows of committed batches, with their ``batch``."""
        # an empty first partition keeps the folder readable before any commit
        deltas_schema = f"{_DELTAS}, batch long"
        self.spark.createDataFrame([], _DELTAS).write.mode("ignore").parquet(f"{self.folder}/batch=-1")
        return self.spark.read.schema(deltas_schema).option("basePath", self.folder).parquet(f"{self.folder}/batch=*")

    def totals(self) -> DataFrame:
        """Source, lang, tokenizer, n_docs, n_tokens, n_chars of keys with documents."""
        sums = self.batches().groupBy(*KEYS).agg(*[F.sum(m).alias(m) for m in MEASURES])
        return sums.where("n_docs <> 0 or n_tokens <> 0 or n_chars <> 0")

    def compact(self, into: Rollup, last: int) -> None:
        """Write batches up to ``last`` as the one batch ``last`` of a new rollup,
        and the later ones as they are. The old folder stays until the caller
        has moved its readers on."""
        rows = checkpointed(self.batches())
        old = rows.where(F.col("batch") <= last).groupBy(*KEYS).agg(*[F.sum(m).alias(m) for m in MEASURES])
        old.write.mode("overwrite").parquet(f"{into.folder}/batch={int(last)}")
        later = rows.where(F.col("batch") > last)
        later.write.mode("overwrite").partitionBy("batch").option("partitionOverwriteMode", "dynamic").parquet(into.folder)


def without_repeated_lines(text: str) -> str:
    """The text with each line that has a word kept at its first place only."""
    seen: set[str] = set()
    out = []
    for line in text.split("\n"):
        if line.split():
            if line in seen:
                continue
            seen.add(line)
        out.append(line)
    return "\n".join(out)


def counted(docs: DataFrame) -> DataFrame:
    """One pass over the texts: doc_id, source, lang, a 128-bit text hash, and
    words, tokens and characters of the text and of its revision without
    repeated lines (the same where there are none)."""
    path, pattern = bpe._paths(None, None)

    def make():
        e = bpe.encoder(path, pattern)

        def work(rows: dict) -> dict:
            import hashlib

            texts = [t or "" for t in rows["text"]]
            news = [without_repeated_lines(t) for t in texts]
            tokens = [len(x) // 4 for x in e.encode(texts)]
            changed = [i for i, (t, n) in enumerate(zip(texts, news, strict=True)) if t != n]
            new_tokens = list(tokens)
            for i, ids in zip(changed, e.encode([news[i] for i in changed]), strict=True):
                new_tokens[i] = len(ids) // 4
            return {
                "doc_id": rows["doc_id"], "source": rows["source"], "lang": rows["lang"],
                "text_hash": [hashlib.blake2b(t.encode(), digest_size=16).hexdigest() for t in texts],
                "old_words": [len(t.encode().split()) for t in texts],
                "new_words": [len(t.encode().split()) for t in news],
                "old_tokens": tokens, "new_tokens": new_tokens,
                "old_chars": [len(t) for t in texts], "new_chars": [len(t) for t in news],
            }

        return work

    schema = (
        "doc_id long, source string, lang string, text_hash string, old_words long, new_words long,"
        " old_tokens long, new_tokens long, old_chars long, new_chars long"
    )
    return map_rows(docs.select("doc_id", "source", "lang", "text"), make, schema, bpe.TEXT_BYTES)


def _changes(rows: DataFrame, op: str) -> DataFrame:
    """CHANGES of both tokenizer versions for counted rows."""
    both = F.array(
        *[
            F.struct(F.lit(name).alias("tokenizer"), F.col(f"old_{c}").alias("old"), F.col(f"new_{c}").alias("new"))
            for name, c in ((WORDS, "words"), (BYTES, "tokens"))
        ]
    )
    new = op == "insert"  # an insert counts the text as it came
    return rows.select("*", F.explode(both).alias("t")).select(
        F.lit(op).alias("op"), "source", "lang", "t.tokenizer",
        F.col("t.old").alias("old_tokens"), "old_chars",
        F.col("t.old" if new else "t.new").alias("new_tokens"),
        F.col("old_chars" if new else "new_chars").alias("new_chars"),
    )


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after the life of the documents: all are inserted; exact copies
    (all but the first of a text) are deleted; texts whose repeated lines go
    are counted anew; and the deletes arrive a second time."""
    rows = checkpointed(counted(table(spark, sf_dir, "documents")))
    rollup = Rollup(spark, fresh_dir(spark, "token_counts"))
    rollup.commit(0, _changes(rows, "insert"))
    # one row for each text; a group of copies is reduced before the shuffle
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "source", "lang")
    firsts = rows.groupBy("text_hash").agg(
        F.min(order).alias("first"), *[F.first(c).alias(c) for c in rows.columns if c.startswith(("old_", "new_"))]
    )
    firsts = checkpointed(firsts.select("first.*", *[c for c in rows.columns if c.startswith(("old_", "new_"))]))
    # deleting all but the firsts is deleting all and inserting the firsts again
    copies = _changes(rows, "delete").unionByName(_changes(firsts, "insert"))
    rollup.commit(1, copies)
    revised = firsts.where("old_chars <> new_chars")
    rollup.commit(2, _changes(revised, "revise"))
    rollup.commit(1, copies)
    return rollup.totals()
