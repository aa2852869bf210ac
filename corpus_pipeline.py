"""From raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept and returns a
DataFrame; all but the last return the columns of ``documents``. The stages choose by
learned scores, fingerprints and hashes that DuckDB's SQL doesn't have, so there is no
ORACLE_SQL. Tests hold each stage on its own input against plain versions: toxicity against the
operator's scores (which a plain scorer checks with the same lexicon), line dedup, near dedup and
BPE against plain results, mixing against the copies that the operator takes.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtrace.llm import bpe, toxicity
from loomtrace.llm.common import cut, forget, numbered, scratch, table
from loomtrace.llm.lines import dedup_lines
from loomtrace.llm.mixing import mixed_documents
from loomtrace.llm.nearcopies import drop_shingle_copies
from loomtrace.llm.queries import BPE_RANKS, held_out


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score of 0.5 or more go."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(~held_out()))
    rows, of, back = numbered(docs)
    return toxicity.score(rows, model, of["text"]).where("_lt_score < 0.5").select(*back)


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 40 code points or more that five documents hold stay in the last; all documents stay."""
    out = dedup_lines(docs)
    own = [f"c{i}" for i in range(len(docs.columns))]
    kinds = dict(docs.dtypes)
    out = out.toDF(*own, "lines", "dropped")
    text = out[own[docs.columns.index("text")]]
    return out.select(*[(F.char_length(text).cast(kinds[old]) if old == "n_chars" else F.col(c)).alias(old) for c, old in zip(own, docs.columns, strict=True)])


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of exact and near copies stays."""
    return drop_shingle_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix to target weights takes them."""
    return mixed_documents(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens and the digests of ids and of the bytes they decode to."""
    ranks = public_tokenizers.path(BPE_RANKS)
    out = bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks)
    return bpe.digests(out, keep_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_common_lines),
    ("near dedup", drop_copies),
    ("mixing", mix),
    ("byte-level BPE", tokenise),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another. Each one's result is written before the next begins, and what
    it had written on the way is deleted then."""
    docs, kept = table(spark, sf_dir, "documents"), []
    for _, stage in STAGES[:-1]:
        with scratch() as made:
            docs = cut(stage(spark, docs, sf_dir))
        forget(spark, kept + made[:-1])
        kept = made[-1:]
    return STAGES[-1][1](spark, docs, sf_dir)
