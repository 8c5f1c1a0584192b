"""Production parameters that queries and the pipeline share."""

from __future__ import annotations

from pyspark.sql import functions as F

from caudal.llm.mixing import Level

#: A text is rejected if its cosine with every language is lower, and it has letters enough to judge by: the cosines of shorter
#: ones are on the edge of the noise of 1024 dimensions.
LEAST_LIKENESS, JUDGED_LETTERS = 0.1, 80
DOMAIN_WEIGHTS = {"d0": 5, "d1": 3, "d2": 2}
LANG_WEIGHTS = {"en": 4, "fr": 2, "de": 2, "es": 2}
MIX_PERCENT, MIX_EPOCHS, MIX_SEED = 60, 4, 1


def mixture_levels() -> list[Level]:
    """Domain (seven sources each, by the number in the source's name), language, source."""
    number = F.coalesce(F.regexp_extract("source", r"([0-9]{1,9})$", 1).try_cast("int"), F.lit(0))
    domain = F.concat(F.lit("d"), F.floor(number / 7).cast("string"))
    return [Level("domain", domain, DOMAIN_WEIGHTS), Level("lang", F.col("lang"), LANG_WEIGHTS), Level("source", F.col("source"))]
