"""What is compared: a table description and the two exports of that table."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import types as T


@dataclass(frozen=True)
class TableSpec:
    """Describes one audited table.

    ``keys`` identify a row in both systems; they must be unique on each side (``operators.keys`` checks that before a
    run). ``fields`` are compared value by value. ``amounts`` are the fields whose deltas are money. ``key_flags`` are
    key columns that get a flag of their own, set on rows that exist on one side only. ``nullable_keys=False`` promises
    that no key is NULL, which lets a join use plain equality and so reuse a bucketed layout. ``on_shared_keys`` says what
    two-sided operators do about keys that a side holds more than once: ``pair`` joins their rows, each with each, ``fail``
    raises, ``set_apart`` leaves them out (``operators.keys.set_apart_shared_keys`` gives them) and ``match`` pairs every row with one
    other at most (``operators.keys.matched_sides``).
    """

    subject: str
    keys: tuple[str, ...]
    fields: tuple[str, ...]
    amounts: tuple[str, ...] = ()
    key_flags: tuple[str, ...] = ()
    nullable_keys: bool = True
    on_shared_keys: str = "pair"

    def __post_init__(self) -> None:
        for name in ("keys", "fields", "amounts", "key_flags"):
            object.__setattr__(self, name, tuple(getattr(self, name)))
        if not self.keys:
            raise ValueError(f"{self.subject}: at least one key is needed")
        if self.on_shared_keys not in ("pair", "fail", "set_apart", "match"):
            raise ValueError(f"{self.subject}: on_shared_keys must be 'pair', 'fail', 'set_apart' or 'match', not {self.on_shared_keys!r}")
        overlap = set(self.keys) & set(self.fields)
        if overlap:
            raise ValueError(f"{self.subject}: {sorted(overlap)} are both keys and fields")
        stray = set(self.key_flags) - set(self.keys)
        if stray:
            raise ValueError(f"{self.subject}: key flags {sorted(stray)} are not keys")


@dataclass(frozen=True)
class TablePair:
    """The source system's and the new system's export of one table."""

    spec: TableSpec
    src: DataFrame
    new: DataFrame

    def __post_init__(self) -> None:
        for side, df in (("source", self.src), ("new", self.new)):
            missing = {*self.spec.keys, *self.spec.fields, *self.spec.amounts} - set(df.columns)
            if missing:
                raise ValueError(f"{self.spec.subject}: {side} side lacks {sorted(missing)}")

    def with_spec(self, **changes) -> TablePair:
        return replace(self, spec=replace(self.spec, **changes))

    def keyed_by(self, *keys: str) -> TablePair:
        """The same pair matched on other keys; former keys become plain fields, new keys stop being fields."""
        spec = self.spec
        return self.with_spec(
            keys=keys,
            fields=tuple(c for c in (*spec.keys, *spec.fields) if c not in keys),
            key_flags=tuple(c for c in spec.key_flags if c in keys),
        )

    def type_of(self, column: str) -> T.DataType:
        return self.src.schema[column].dataType
