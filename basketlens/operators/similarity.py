"""Product catalogue, embeddings and top-k similar products."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.constants import CATALOGUE_SIZE, EMBED_BATCH, TOP_K
from basketlens.operators.reports import product_rollup
from basketlens.session import materialize

# Rows of a block: a pair of blocks is a matrix of 16 MB.
QUERY_ROWS = 2_000
PRODUCT_ROWS = 1_000


def product_catalogue(transactions: DataFrame, n: int = CATALOGUE_SIZE) -> DataFrame:
    """The ``n`` products with the most sales lines."""
    return product_rollup(transactions).orderBy(F.desc("sales_volume"), "description").limit(n)


def embed_with(
    df: DataFrame,
    function: Callable[[list[str]], list[list[float]]],
    text: str = "description",
    batch: int = EMBED_BATCH,
) -> DataFrame:
    """Add ``embedding`` with a user's function over batches of ``batch`` texts.

    The function runs in the Python workers; a model it needs is loaded there.
    """
    schema = T.StructType([*df.schema.fields, T.StructField("embedding", T.ArrayType(T.DoubleType()))])

    def embed(frames: Iterator) -> Iterator:
        for frame in frames:
            for start in range(0, len(frame), batch):
                part = frame.iloc[start : start + batch].copy()
                part["embedding"] = function(part[text].tolist())
                yield part

    return df.mapInPandas(embed, schema)


def embed_by_terms(df: DataFrame, text: str = "description", dimensions: int = 64) -> DataFrame:
    """Embedding without a model: hashed terms weighted by rarity, length 1."""
    stages = [
        RegexTokenizer(inputCol=text, outputCol="_terms", pattern=r"\W+"),
        HashingTF(inputCol="_terms", outputCol="_counts", numFeatures=dimensions),
        IDF(inputCol="_counts", outputCol="_weights"),
        Normalizer(inputCol="_weights", outputCol="_unit"),
    ]
    fitted = Pipeline(stages=stages).fit(df)
    return (
        fitted.transform(df)
        .withColumn("embedding", vector_to_array("_unit"))
        .drop("_terms", "_counts", "_weights", "_unit")
    )


def similar_products(queries: DataFrame, catalogue: DataFrame, k: int = TOP_K) -> DataFrame:
    """The ``k`` catalogue products most similar to each query by cosine, best first.

    ``queries`` has ``query_id``, ``query_text`` (null matches no description)
    and ``embedding``. A product described like the query is left out. A zero
    vector has no similarity and comes last; equal similarities go by description.

    Both sides are cut into blocks of bounded size and each pair of blocks is
    one group, so no group grows with the data. A pair returns at most ``k``
    rows per query; the best ``k`` of those are kept.
    """
    pairs, queries = _by_block(queries, catalogue, _matcher(k), _match_fields())
    best = Window.partitionBy("query").orderBy(
        F.round("similarity", 12).desc_nulls_last(), "description", "stock_code"
    )
    top = pairs.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return top.join(queries, "query").select("query_id", *[field.name for field in _match_fields()])


def similarity_range(queries: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Per query: products ``compared``, and the ``best`` and ``worst`` similarity.

    Summed up inside each pair of blocks, so no query meets its products as rows.
    """
    fields = [
        T.StructField("compared", T.LongType()),
        T.StructField("best", T.DoubleType()),
        T.StructField("worst", T.DoubleType()),
    ]

    def summarise(frame, products):
        import numpy as np
        import pandas as pd

        similarity, same = _similarities(frame, products)
        similarity = np.where(same, np.nan, similarity)
        with np.errstate(all="ignore"):
            best, worst = pd.DataFrame(similarity).max(axis=1), pd.DataFrame(similarity).min(axis=1)
        return pd.DataFrame(
            {"query": frame["query"].to_numpy(), "compared": (~same).sum(axis=1), "best": best, "worst": worst}
        )

    parts, queries = _by_block(queries, catalogue, summarise, fields)
    summed = parts.groupBy("query").agg(
        F.sum("compared").alias("compared"), F.max("best").alias("best"), F.min("worst").alias("worst")
    )
    return summed.join(queries, "query").select("query_id", "compared", "best", "worst")


def _by_block(
    queries: DataFrame, catalogue: DataFrame, function: Callable, fields: list[T.StructField]
) -> tuple[DataFrame, DataFrame]:
    """``function`` of every pair of blocks, and the ``query`` numbers with their ids."""
    asked = queries.select("query_id", "query_text", "embedding").where(F.col("embedding").isNotNull())
    offered = catalogue.select("stock_code", "description", "unit_price", "embedding").where(
        F.col("embedding").isNotNull()
    )
    asked = materialize(asked.withColumn("query", F.monotonically_increasing_id()), "queries")
    offered = materialize(offered.withColumn("product", F.monotonically_increasing_id()), "products")
    query_blocks = max(1, -(-asked.count() // QUERY_ROWS))
    product_blocks = max(1, -(-offered.count() // PRODUCT_ROWS))

    def block(name: str, count: int):
        return F.pmod(F.xxhash64(name), F.lit(count)).cast("int")

    def every(count: int):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    left = asked.select("query", "query_text", "embedding", block("query", query_blocks).alias("_q"), every(product_blocks).alias("_p"))
    right = offered.select("*", block("product", product_blocks).alias("_p"), every(query_blocks).alias("_q"))
    schema = T.StructType([T.StructField("query", T.LongType()), *fields])
    names = [field.name for field in schema]

    def meet(frame, products):
        import pandas as pd

        if not len(frame) or not len(products):
            return pd.DataFrame({name: [] for name in names})
        products = products.sort_values(["description", "stock_code"], kind="stable", ignore_index=True)
        return function(frame, products)

    pairs = left.groupBy("_q", "_p").cogroup(right.groupBy("_q", "_p")).applyInPandas(meet, schema)
    return pairs, asked.select("query", "query_id")


def _match_fields() -> list[T.StructField]:
    return [
        T.StructField("rank", T.IntegerType()),
        T.StructField("stock_code", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("unit_price", T.DoubleType()),
        T.StructField("similarity", T.DoubleType()),
    ]


def _similarities(frame, products):
    """(cosines, whether the texts are the same) of every query and product of a pair of blocks."""
    import numpy as np
    import pandas as pd

    asked = np.stack(frame["embedding"].to_list()).astype("float64")
    offered = np.stack(products["embedding"].to_list()).astype("float64")
    lengths = np.linalg.norm(asked, axis=1)[:, None] * np.linalg.norm(offered, axis=1)[None, :]
    with np.errstate(divide="ignore", invalid="ignore"):
        similarity = np.where(lengths == 0, np.nan, asked @ offered.T / lengths)
    codes, _ = pd.factorize(pd.concat([products["description"].str.lower(), frame["query_text"].astype("object").str.lower()]))
    names, texts = codes[: len(products)], codes[len(products) :]  # no text has the code -1
    return similarity, (names[None, :] == texts[:, None]) & (texts >= 0)[:, None]


def _matcher(k: int) -> Callable:
    """Top-k products for a batch of queries, as one matrix product."""

    def match(frame, products):
        import numpy as np
        import pandas as pd

        similarity, same = _similarities(frame, products)
        # Rounded for the order only, so that equal vectors keep the order of the descriptions.
        distance = np.where(np.isnan(similarity), 2.0, -np.round(similarity, 12))
        distance[same] = np.inf
        few = min(k, distance.shape[1])
        # everything up to the k-th distance, ties with it included, is then sorted
        limit = np.partition(distance, few - 1, axis=1)[:, few - 1 : few]
        rows, picked = np.nonzero((distance <= limit) & ~same)
        order = np.lexsort((picked, distance[rows, picked], rows))
        rows, picked = rows[order], picked[order]
        ranks = np.arange(len(rows)) - np.searchsorted(rows, rows) + 1
        keep = ranks <= k
        rows, picked, ranks = rows[keep], picked[keep], ranks[keep]
        found = products.iloc[picked]
        return pd.DataFrame(
            {
                "query": frame["query"].to_numpy()[rows],
                "rank": ranks.astype("int32"),
                "stock_code": found["stock_code"].to_numpy(),
                "description": found["description"].to_numpy(),
                "unit_price": found["unit_price"].to_numpy(),
                "similarity": similarity[rows, picked],
            }
        )

    return match
