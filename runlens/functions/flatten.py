"""Messages to flat numeric fields.

A flattener turns one payload (VARIANT) into
``struct(fields ARRAY<STRUCT<field, value ARRAY<FLOAT>, scalar BOOLEAN>>, failed STRING)``.
``failed`` names the first missing required attribute and is NULL otherwise.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FIELDS_TYPE = "array<struct<field:string,value:array<float>,scalar:boolean>>"
Flattener = Callable[[Column], Column]
# Levels walked where the caller has not asked the data (``needed_depth``);
# deeper messages are reported as failed, never cut silently.
MAX_DEPTH = 12


def _entry(field: Column, value: Column, scalar: Column) -> Column:
    return F.struct(
        field.cast("string").alias("field"),
        value.cast("array<float>").alias("value"),
        scalar.alias("scalar"),
    )


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` written, and computed, only once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _outcome(fields: Column, failed: Column) -> Column:
    return F.struct(
        F.when(failed.isNull(), fields).otherwise(F.array().cast(FIELDS_TYPE)).cast(FIELDS_TYPE).alias("fields"),
        failed.alias("failed"),
    )


def _vectors(spec: Mapping[str, tuple[str, str]], optional: bool = False) -> Flattener:
    """Vectors stored as named components: field to (path, component names)."""

    def flatten(msg: Column) -> Column:
        parts = []
        for field, (path, axes) in spec.items():
            present = F.try_variant_get(msg, path, "variant").isNotNull() if optional else F.lit(True)
            parts.append(
                F.struct(
                    F.lit(field).alias("field"),
                    F.array(*[F.try_variant_get(msg, f"{path}.{x}", "double") for x in axes]).alias("value"),
                    present.alias("present"),
                    F.array(*[F.lit(f"{path[2:]}.{x} missing") for x in axes]).alias("missing"),
                )
            )

        def finish(found: Column) -> Column:
            given = F.filter(found, lambda v: v["present"])
            gaps = F.flatten(
                F.transform(
                    given,
                    lambda v: F.zip_with(v["value"], v["missing"], lambda x, m: F.when(x.isNull(), m)),
                )
            )
            return _outcome(
                F.transform(given, lambda v: _entry(v["field"], v["value"], F.lit(False))),
                F.try_element_at(F.array_compact(gaps), F.lit(1)),
            )

        return _let(F.array(*parts), finish)

    return flatten


def joint_state(msg: Column) -> Column:
    parts = [
        F.struct(
            F.lit(field).alias("field"),
            F.try_variant_get(msg, f"$.{field}", "array<double>").alias("value"),
            F.schema_of_variant(F.try_variant_get(msg, f"$.{field}", "variant")).alias("kind"),
        )
        for field in ("position", "velocity", "effort")
    ]

    def finish(found: Column) -> Column:
        usable = F.filter(found, lambda v: F.size(v["value"]) > 0)
        wrong = F.filter(found, lambda v: v["value"].isNull() & (v["kind"] != "VOID"))
        first = F.try_element_at(wrong, F.lit(1))["field"]
        return _outcome(
            F.transform(usable, lambda v: _entry(v["field"], v["value"], F.lit(False))),
            F.concat(first, F.lit(" is not a list of numbers")),
        )

    return _let(F.array(*parts), finish)


_NUMERIC = "^(BIGINT|DECIMAL|DOUBLE|FLOAT|BOOLEAN)"
_NUMERIC_LIST = r"^ARRAY<(BIGINT|DECIMAL\([0-9]+,[0-9]+\)|DOUBLE|FLOAT)>$"


def _children(parent: Column) -> Column:
    """Members of an object node; names starting with ``_`` are private."""
    members = F.map_entries(F.try_variant_get(parent["node"], "$", "map<string,variant>"))
    visible = F.filter(members, lambda m: ~m["key"].startswith("_"))
    return F.transform(
        visible,
        lambda m: F.struct(
            F.concat_ws(".", parent["path"], m["key"]).alias("path"),
            m["value"].alias("node"),
            F.schema_of_variant(m["value"]).alias("kind"),
        ),
    )


def _walk(parent: Column, depth: int) -> Column:
    """Entries below a node; strings, nulls and object lists are left out.

    Each level works on a lambda variable, so the expression grows by the same
    amount per level.
    """

    def leaf_or_branch(n: Column) -> Column:
        here = _leaf(n["path"], n["node"], n["kind"])
        if depth <= 1:
            too_deep = F.array(_entry(n["path"], F.lit(None), F.lit(False)))
            below = F.when(n["kind"] == "OBJECT<>", F.array().cast(FIELDS_TYPE)).otherwise(too_deep)
        else:
            below = _walk(n, depth - 1)
        return F.when(n["kind"].startswith("OBJECT"), below).otherwise(here)

    return F.flatten(F.transform(_children(parent), leaf_or_branch))


def _leaf(path: Column, node: Column, kind: Column) -> Column:
    return (
        F.when(
            kind.rlike(_NUMERIC),
            F.array(_entry(path, F.array(F.try_variant_get(node, "$", "double")), F.lit(True))),
        )
        .when(
            kind.rlike(_NUMERIC_LIST),
            F.array(_entry(path, F.try_variant_get(node, "$", "array<double>"), F.lit(False))),
        )
        .otherwise(F.array().cast(FIELDS_TYPE))
    )


def generic(msg: Column, depth: int = MAX_DEPTH) -> Column:
    """Every numeric leaf of any message, under its dotted path."""
    root = F.struct(
        F.lit(None).cast("string").alias("path"),
        msg.alias("node"),
        F.schema_of_variant(msg).alias("kind"),
    )
    found = _let(
        root,
        lambda r: F.when(r["kind"].startswith("OBJECT"), _walk(r, depth)).otherwise(
            _leaf(F.lit("value"), r["node"], r["kind"])
        ),
    )
    found = F.coalesce(found, F.array().cast(FIELDS_TYPE)).cast(FIELDS_TYPE)

    def finish(fields: Column) -> Column:
        deep = F.exists(fields, lambda e: e["value"].isNull())
        return F.struct(
            F.when(deep, F.array().cast(FIELDS_TYPE)).otherwise(fields).alias("fields"),
            F.when(deep, F.lit(f"nested deeper than {depth} levels")).alias("failed"),
        )

    return _let(found, finish)


imu = _vectors(
    {
        "orientation": ("$.orientation", "xyzw"),
        "angular_velocity": ("$.angular_velocity", "xyz"),
        "linear_acceleration": ("$.linear_acceleration", "xyz"),
    },
    optional=True,
)
twist = _vectors({"linear": ("$.linear", "xyz"), "angular": ("$.angular", "xyz")})
twist_stamped = _vectors(
    {"linear": ("$.twist.linear", "xyz"), "angular": ("$.twist.angular", "xyz")}
)
wrench = _vectors({"force": ("$.force", "xyz"), "torque": ("$.torque", "xyz")})
wrench_stamped = _vectors(
    {"force": ("$.wrench.force", "xyz"), "torque": ("$.wrench.torque", "xyz")}
)
pose_stamped = _vectors(
    {"position": ("$.pose.position", "xyz"), "orientation": ("$.pose.orientation", "xyzw")}
)
odometry = _vectors(
    {
        "position": ("$.pose.pose.position", "xyz"),
        "orientation": ("$.pose.pose.orientation", "xyzw"),
        "linear_velocity": ("$.twist.twist.linear", "xyz"),
        "angular_velocity": ("$.twist.twist.angular", "xyz"),
    }
)

FLATTENERS: dict[str, Flattener] = {
    "sensor_msgs/msg/JointState": joint_state,
    "sensor_msgs/msg/Imu": imu,
    "geometry_msgs/msg/Twist": twist,
    "geometry_msgs/msg/TwistStamped": twist_stamped,
    "geometry_msgs/msg/Wrench": wrench,
    "geometry_msgs/msg/WrenchStamped": wrench_stamped,
    "geometry_msgs/msg/PoseStamped": pose_stamped,
    "nav_msgs/msg/Odometry": odometry,
}


def flatten_message(
    msgtype: Column, payload: Column, custom: Mapping[str, Flattener] | None = None, depth: int = MAX_DEPTH
) -> Column:
    """Dispatch on the message type; unknown types take the generic walk of ``depth`` levels.

    ``custom`` adds or replaces flatteners without touching the registry.
    """
    out = None
    for name, fn in {**FLATTENERS, **(custom or {})}.items():
        branch = fn(payload)
        out = F.when(msgtype == name, branch) if out is None else out.when(msgtype == name, branch)
    return out.otherwise(generic(payload, depth))


def needed_depth(messages: DataFrame, custom: Mapping[str, Flattener] | None = None) -> int:
    """Object levels of the deepest message that takes the generic walk; one pass over ``(msgtype, payload)``."""
    known = [*FLATTENERS, *(custom or {})]
    kinds = messages.where(~F.col("msgtype").isin(*known)).select(F.schema_of_variant("payload").alias("kind")).distinct()
    # The count of object brackets bounds the nesting of one schema from above.
    bound = kinds.agg(F.max(F.regexp_count("kind", F.lit("OBJECT<")))).first()[0]
    return max(1, bound or 0)


def shape_text(value: Column, scalar: Column) -> Column:
    """Shape as shown in notes: ``()`` for a scalar, ``(n,)`` for a vector."""
    return F.when(scalar, F.lit("()")).otherwise(F.format_string("(%d,)", F.size(value)))


# ── rollout spaces ───────────────────────────────────────────────────


def flatten_space(value: Column, space: T.DataType, prefix: str) -> list[tuple[str, Column]]:
    """``(key, ARRAY<FLOAT>)`` pairs of a value laid out by its declared type.

    Structs are dictionary spaces (or tuples, when their fields are named
    ``_1``, ``_2``, …), arrays are boxes and numbers are discrete values.
    """
    if isinstance(space, T.StructType):
        out: list[tuple[str, Column]] = []
        for i, f in enumerate(space.fields):
            name = str(i) if f.name == f"_{i + 1}" else f.name
            out += flatten_space(value[f.name], f.dataType, f"{prefix}.{name}")
        return out
    if isinstance(space, T.ArrayType):
        depth = space
        flat = value
        while isinstance(depth.elementType, T.ArrayType):
            flat = F.flatten(flat)
            depth = depth.elementType
        return [(prefix, flat.cast("array<float>"))]
    if isinstance(space, (T.NumericType, T.BooleanType)):
        return [(prefix, F.array(value.cast("float")))]
    raise TypeError(f"unsupported space {space.simpleString()} at {prefix}")
