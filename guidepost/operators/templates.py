from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guidepost.functions import TOKEN_PATTERN, column, free_name
from guidepost.plans import MAX_BROADCAST_BYTES, apart, broadcast_if_small
from guidepost.sources import snapshot


def render_templates(
    templates: DataFrame,
    token_map: DataFrame,
    template: str = "select_template",
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """``templates`` with ``rendered``, the text with tokens replaced by column names, and
    ``unresolved``, the sorted tokens that have no name and were left in the text.

    All tokens of a text are replaced at once, so an inserted name is never searched again.
    If the token map gives several names for one token, the smallest is used. How
    templates are filled in is this library's own definition.

    Templates are not matched against the whole map. The tokens each text holds are
    looked up by equality, once for each distinct set of tokens, so however many rows share
    a text and however long the map is, a group is never longer than one text. Names and sets are
    stored and measured; small ones are broadcast, so the templates are not shuffled.
    """
    pattern = F.lit(TOKEN_PATTERN)
    found, tokens, names_ = (free_name(templates, n) for n in ("found", "tokens", "names"))
    tagged = templates.withColumn(
        found, F.regexp_extract_all(column(template), pattern, 0)
    ).withColumn(tokens, F.sort_array(F.array_distinct(found)))

    names = snapshot(
        token_map.where(F.col("token").isNotNull())
        .groupBy(F.col("token"), apart("token"))
        .agg(F.min("dest_name").alias("name"))
        .where(F.col("name").isNotNull())
        .select("token", "name"),
        "token-names",
    )
    sets = tagged.where(F.size(tokens) > 0).select(F.col(tokens).alias("tokens")).distinct()
    known = snapshot(
        sets.select("tokens", F.explode("tokens").alias("token"))
        .join(broadcast_if_small(names, max_broadcast_bytes), "token")
        .groupBy("tokens", apart("tokens"))
        .agg(F.map_from_entries(F.collect_list(F.struct("token", "name"))).alias(names_))
        .select(F.col("tokens").alias(tokens), names_),
        "token-sets",
    )

    literals = F.split(column(template), TOKEN_PATTERN, -1)
    # One literal more than tokens: zip_with pads the shorter list with null.
    pieces = F.zip_with(
        literals,
        found,
        lambda text, token: F.concat(
            text,
            F.coalesce(F.try_element_at(names_, token), token, F.lit("")),
        ),
    )
    unresolved = F.when(F.col(names_).isNull(), F.col(tokens)).otherwise(
        F.array_except(tokens, F.map_keys(names_))
    )
    return tagged.join(broadcast_if_small(known, max_broadcast_bytes), tokens, "left").select(
        *[column(name) for name in templates.columns],
        F.array_join(pieces, "").alias("rendered"),
        unresolved.alias("unresolved"),
    )
