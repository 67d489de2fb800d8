"""Wide role columns to one row per role."""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F


def unpivot_roles(
    df: DataFrame, roles: Mapping[str, Mapping[str, str]], role: str | None, keep: Sequence[str]
) -> DataFrame:
    """One row per input row and role, from a single scan.

    ``roles`` maps each role name to ``{output column: source column}``. The role name goes into
    column ``role``, if one is asked for, and the ``keep`` columns are carried along.
    """
    entries = []
    for name, columns in roles.items():
        fields = [F.col(source).alias(target) for target, source in columns.items()]
        if role is not None:
            fields.insert(0, F.lit(name).alias(role))
        entries.append(F.struct(*fields))
    return df.select(*keep, F.explode(F.array(*entries)).alias("_role")).select("_role.*", *keep)
