"""Write commands, applied as a batch: validate, route by schema family, apply to the legacy rows, emit changes.

A command is one row: seq (unique, not negative, gives the order), kind, tenant_id, legacy_id, the person columns, extra_field,
modernized_only, the six data columns, and `present`, the names of the fields that were given. Kinds are `create` and
`update` (they know extra_field only) and `legacy_create` and `legacy_update` (they know the family's own columns).
Callers supply the ids of new rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeloom import schemas
from changeloom.functions.envelope import envelope
from changeloom.operators.ordered import carry_forward
from changeloom.schemas import COMMON_COLUMNS, DATA_COLUMNS, EXTRA_FIELD_COLUMN, FAMILY_COLUMNS, KEY

CREATES = ("create", "legacy_create")
UPDATES = ("update", "legacy_update")


def _blank(name: str) -> Column:
    return F.coalesce(F.col(name) == "", F.lit(True))


def validate(commands: DataFrame, dimension: DataFrame) -> DataFrame:
    """Adds legacy_type, status (accepted or rejected) and the reason. Required fields are checked before the tenant."""
    create_gap = _blank("tenant_id") | _blank("firstname") | _blank("surname")
    update_gap = _blank("tenant_id") | F.col("legacy_id").isNull() | (F.col("legacy_id") == 0)
    unknown = F.when(F.col("legacy_type").isNull(), F.concat(
        F.lit("unknown tenant "), F.coalesce("tenant_id", F.lit("None"))))
    reason = (
        F.when((F.col("kind") == "create") & create_gap, F.lit("tenant_id, firstname, and surname are required"))
        .when((F.col("kind") == "update") & update_gap, F.lit("tenant_id and legacy_id are required"))
        .otherwise(unknown)
    )
    known = commands.join(dimension.select("tenant_id", "legacy_type", "topic"), "tenant_id", "left")
    return known.withColumn("reason", reason).withColumn(
        "status", F.when(F.col("reason").isNull(), "accepted").otherwise("rejected")
    )


def _family(name: str) -> str:
    return next(f for f, columns in FAMILY_COLUMNS.items() if name in columns)


def _create_value(name: str) -> str:
    """What a create puts into a data column, as SQL. Empty texts become NULL."""
    family = _family(name)
    from_extra = "nullif(extra_field, '')" if EXTRA_FIELD_COLUMN[family] == name else "CAST(NULL AS STRING)"
    return f"CASE WHEN legacy_type = '{family}' THEN CASE kind WHEN 'create' THEN {from_extra} ELSE nullif({name}, '') END END"


def route_creates(valid: DataFrame) -> DataFrame:
    """The legacy rows that accepted creates insert."""
    return valid.where((F.col("status") == "accepted") & F.col("kind").isin(*CREATES)).select(
        "seq", "topic", "tenant_id", "legacy_type", "legacy_id",
        *COMMON_COLUMNS,
        *[F.expr(_create_value(c)).alias(c) for c in DATA_COLUMNS],
    )


def _set_value(name: str) -> str:
    """What an update sets a data column to, as SQL; NULL where it leaves the column alone.

    `update` always sets the family's extra_field column: to '' where the field is missing, to NULL where it is given
    as null. `legacy_update` sets a column only to a non-empty text. The struct with its seq lets NULL be set.
    """
    family = _family(name)
    by_update = ""
    if EXTRA_FIELD_COLUMN[family] == name:
        value = "CASE WHEN array_contains(present, 'extra_field') THEN extra_field ELSE '' END"
        by_update = f"WHEN kind = 'update' AND legacy_type = '{family}' THEN named_struct('v', {value}, 'seq', seq)"
    return f"""CASE {by_update} WHEN kind = 'legacy_update' AND legacy_type = '{family}' AND {name} <> ''
        THEN named_struct('v', {name}, 'seq', seq) END"""


def _first_creates(valid: DataFrame) -> DataFrame:
    """The first create of each key. A second one for the same key is refused."""
    rows = route_creates(valid)
    payload = [c for c in rows.columns if c not in KEY]
    return rows.groupBy(*KEY).agg(F.min_by(F.struct(*payload), "seq").alias("__row")).select(*KEY, "__row.*")


def _timeline(snapshot: DataFrame, commands: DataFrame, dimension: DataFrame, images: bool) -> DataFrame:
    """Each command with its final status and, where wanted, the data columns of its row right after it.

    The existing rows that commands ask for are put before the first command (they have no kind). A row and its
    commands then form one timeline per key, which `carry_forward` handles in slices; a join of the commands with
    their rows would send all commands of a hot key to one task. `base` is the first row of a key, existing or created:
    a later create of the key is refused, and an update before it finds no row.
    """
    columns = list(DATA_COLUMNS) if images else []
    asked = commands.select(*KEY).distinct()
    existing = snapshot.select(*KEY, *columns).join(asked, KEY, "left_semi").withColumn(
        "seq", F.lit(-1).cast("bigint"))
    rows = validate(commands, dimension).unionByName(existing, allowMissingColumns=True)
    whole_row = ", ".join(f"'{c}', CASE WHEN kind IS NULL THEN {c} ELSE {_create_value(c)} END" for c in columns)
    base = F.expr(f"""CASE WHEN kind IS NULL OR (status = 'accepted' AND kind IN ('create', 'legacy_create'))
        THEN named_struct('seq', seq{', ' + whole_row if images else ''}) END""")
    sets = {
        f"set_{c}": F.expr(f"CASE WHEN status = 'accepted' THEN {_set_value(c)} END") for c in columns
    }
    seen = carry_forward(rows, KEY, "seq", sets, {"base": base}, inclusive=True).where(F.col("kind").isNotNull())
    fault = """CASE WHEN status = 'rejected' THEN reason
        WHEN kind IN ('create', 'legacy_create') AND base.seq < seq THEN 'duplicate id'
        WHEN kind = 'legacy_update' AND base IS NULL THEN 'record not found' END"""
    return seen.withColumn("fault", F.expr(fault)).withColumns({
        "status": F.expr("""CASE WHEN fault IS NOT NULL THEN 'rejected'
            WHEN kind = 'update' AND base IS NULL THEN 'no_row' ELSE 'applied' END"""),
        "reason": F.col("fault"),
    }).drop("fault")


def resolve(snapshot: DataFrame, commands: DataFrame, dimension: DataFrame) -> DataFrame:
    """Each command with its final status: applied, no_row (an update of an unknown id) or rejected."""
    return _timeline(snapshot, commands, dimension, images=False).drop("base")


def fold_updates(valid: DataFrame) -> DataFrame:
    """All updates of a key as one row: the common columns of the last one, and per data column the last value set."""
    updates = valid.where((F.col("status") == "accepted") & F.col("kind").isin(*UPDATES))
    with_sets = updates.selectExpr("*", *[f"{_set_value(c)} AS __set_{c}" for c in DATA_COLUMNS])
    return with_sets.groupBy(*KEY).agg(
        F.max_by(F.struct(*COMMON_COLUMNS, "seq"), "seq").alias("__last"),
        *[
            F.expr(f"max_by(__set_{c}, __set_{c}.seq) AS __set_{c}")
            for c in DATA_COLUMNS
        ],
    )


def apply(snapshot: DataFrame, commands: DataFrame, dimension: DataFrame) -> DataFrame:
    """The legacy rows after all commands.

    Applying the updates of a key in order comes down to one aggregate per key (`fold_updates`), with no window and
    with a partial aggregate before its shuffle. Updates that precede the creation of their row have no effect. Keys
    always include the tenant, so a command never reaches another tenant's row of the same id.
    """
    valid = validate(commands, dimension)
    columns = [*KEY, *COMMON_COLUMNS, *DATA_COLUMNS]
    folded = fold_updates(valid)
    existing = snapshot.select(*columns, F.lit(None).cast("bigint").alias("created_seq"))
    created = _first_creates(valid).select(*columns, F.col("seq").alias("created_seq")).join(
        snapshot.select(*KEY), KEY, "left_anti"
    )

    def updated(rows: DataFrame) -> DataFrame:
        def pick(update: str, seq: str, name: str) -> str:
            later = f"{seq} IS NOT NULL AND (created_seq IS NULL OR {seq} > created_seq)"
            return f"CASE WHEN {later} THEN {update} ELSE {name} END AS {name}"

        return rows.join(folded, KEY, "left").selectExpr(
            *KEY,
            *[pick(f"__last.{c}", "__last.seq", c) for c in COMMON_COLUMNS],
            *[pick(f"__set_{c}.v", f"__set_{c}.seq", c) for c in DATA_COLUMNS],
        )

    return updated(existing).unionByName(updated(created))


def patch_target_only(target: DataFrame, commands: DataFrame, dimension: DataFrame) -> DataFrame:
    """The target with modernized_only overwritten by the last update that gave one. It cannot be cleared, and a key
    that is not in the target yet is left out."""
    valid = validate(commands, dimension)
    patches = (
        valid.where((F.col("status") == "accepted") & (F.col("kind") == "update")
                    & F.col("modernized_only").isNotNull())
        .groupBy(*KEY)
        .agg(F.max_by("modernized_only", "seq").alias("__patch"))
    )
    return (
        target.join(patches, KEY, "left")
        .withColumn("modernized_only", F.coalesce("__patch", "modernized_only"))
        .select(*target.columns)
    )


def row_images(snapshot: DataFrame, commands: DataFrame, dimension: DataFrame) -> DataFrame:
    """The legacy row as it stood right after each applied command.

    The common columns are the command's own. A data column is the last value set up to and with the command: by the
    existing row, by the create, or by an update.
    """
    applied = _timeline(snapshot, commands, dimension, images=True).where(F.col("status") == "applied")
    return applied.select(
        "seq", "topic", "tenant_id", "legacy_type", "legacy_id",
        *COMMON_COLUMNS,
        *[F.expr(f"CASE WHEN set_{c}.seq > base.seq THEN set_{c}.v ELSE base.{c} END AS {c}") for c in DATA_COLUMNS],
        F.when(F.col("kind").isin(*CREATES), "c").otherwise("u").alias("op"),
    )


def to_changes(images: DataFrame, written_at: Column) -> DataFrame:
    """Row images as change messages, in the form that the decode reads: the loop is closed."""

    def image(family: str) -> Column:
        return F.struct(
            F.col("legacy_id").alias("id"), "firstname", "surname",
            F.unix_date("date_of_birth").alias("date_of_birth"), "city", *FAMILY_COLUMNS[family],
        )

    families = list(FAMILY_COLUMNS)
    value = F.when(F.col("legacy_type") == families[0], envelope(F.col("op"), None, image(families[0])))
    value = value.otherwise(envelope(F.col("op"), None, image(families[1])))
    return images.select(
        "topic",
        F.lit(0).alias("partition"),
        F.col("seq").alias("offset"),
        written_at.cast("timestamp_ntz").alias("timestamp"),
        value.alias("value"),
    )
