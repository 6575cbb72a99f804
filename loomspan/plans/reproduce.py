"""Making a run again from its manifest."""

from __future__ import annotations

import tomllib

from pyspark.sql import DataFrame, SparkSession

from loomspan.operators import manifest


def without_nulls(value):
    """TOML has no null: keys and entries without a value are left out."""
    if isinstance(value, dict):
        return {k: without_nulls(v) for k, v in value.items() if v is not None}
    return [without_nulls(v) for v in value if v is not None] if isinstance(value, list) else value


def _value(v) -> str:
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (int, float)):
        return repr(v)
    if isinstance(v, list):
        return "[" + ", ".join(map(_value, v)) + "]"
    escaped = "".join(f"\\u{ord(c):04x}" if ord(c) < 32 or ord(c) == 127 else "\\" + c if c in "\"\\" else c for c in str(v))
    return f'"{escaped}"'


def _table(values: dict, path: tuple[str, ...]) -> list[str]:
    key = lambda k: k if k.replace("_", "").replace("-", "").isalnum() and k.isascii() else _value(k)
    out = [f"[{'.'.join(map(key, path))}]"] if path else []
    out += [f"{key(k)} = {_value(v)}" for k, v in sorted(values.items()) if not isinstance(v, dict)]
    for k, v in sorted(values.items()):
        if isinstance(v, dict):
            out += ["", *_table(v, (*path, k))]
    return out


def render_toml(config: dict) -> str:
    """A configuration as TOML; an error if it doesn't read back as the same."""
    plain = without_nulls(config)
    text = "\n".join(_table(plain, ())).lstrip("\n") + "\n"
    if tomllib.loads(text) != plain:
        raise ValueError("the configuration can't be written as TOML")
    return text


def config_of(m: dict) -> str:
    """The configuration that a manifest holds, with its seed, as TOML."""
    return render_toml(m["config"] | {"seed": m["seed"]})


def input_status(spark: SparkSession, m: dict, now: dict[str, str]) -> DataFrame:
    """``name, status`` of the manifest's inputs against present fingerprints."""
    frame = lambda d: spark.createDataFrame(sorted(d.items()), "name string, sha256 string")
    return manifest.changed_inputs(frame(m["input_hashes"]), frame(now))
