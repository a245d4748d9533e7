"""Vector expressions on array<float> columns, without Python."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperweave.schemas import MODEL_DIMENSIONS

WORD_BITS = 64


def model_dimension(model: Column) -> Column:
    """Width of the vectors of each row's model; an unknown model is an error."""
    known = F.create_map(*[F.lit(x) for pair in MODEL_DIMENSIONS.items() for x in pair])
    problem = F.raise_error(F.concat(F.lit("unknown model "), F.coalesce(model, F.lit("null")))).cast("int")
    return F.coalesce(F.try_element_at(known, model), problem)


def of_dimension(vector: Column, dim: int, row: Column) -> Column:
    """The vector itself; one of another width, or none, is an error when it is computed."""
    problem = F.concat(F.lit("vector "), row.cast("string"), F.lit(f" does not have {dim} dimensions"))
    return F.when(F.size(vector) == dim, vector).otherwise(F.raise_error(problem).cast("array<float>"))


def unit_normalize(vector: Column, to: str = "float") -> Column:
    """Vector divided by its length; a zero vector gives null elements."""
    # The length lives in the aggregate's finish lambda, so it is computed once
    # per vector and not once per element.
    return F.aggregate(
        vector,
        F.lit(0.0),
        lambda total, x: total + x.cast("double") * x.cast("double"),
        lambda total: F.transform(
            vector, lambda x: F.try_divide(x.cast("double"), F.sqrt(total)).cast(to)),
    )


def bit_string(vector: Column) -> Column:
    """One character per dimension: '1' where the value is above zero."""
    return F.array_join(F.transform(vector, lambda x: F.when(x > 0, "1").otherwise("0")), "")


def bit_words(vector: Column) -> Column:
    """One bit per dimension packed into 64-bit words, first dimension in the top bit.

    A last word with fewer dimensions holds them in its low bits.
    """
    words = F.ceil(F.size(vector) / F.lit(WORD_BITS)).cast("int")
    starts = F.transform(F.sequence(F.lit(1), words), lambda w: (w - 1) * WORD_BITS + 1)
    packed = F.transform(
        starts,
        lambda at: F.aggregate(
            F.slice(vector, at, F.lit(WORD_BITS)),
            F.lit(0).cast("bigint"),
            lambda word, x: F.shiftleft(word, 1).bitwiseOR(
                F.when(x > 0, F.lit(1)).otherwise(F.lit(0)).cast("bigint")),
        ),
    )
    return F.when(F.size(vector) > 0, packed).when(
        F.size(vector) == 0, F.array().cast("array<bigint>"))


def hamming(left: Column, right: Column) -> Column:
    """Number of differing bits between two word lists."""
    return F.aggregate(
        F.zip_with(left, right, lambda a, b: F.bit_count(a.bitwiseXOR(b)).cast("int")),
        F.lit(0),
        lambda total, bits: total + bits,
    )
