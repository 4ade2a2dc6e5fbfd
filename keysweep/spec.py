"""What a run must know about one replicated table."""

from __future__ import annotations

from dataclasses import dataclass

# Flag and storage conventions of the replica tables.
DELETED = "1"
FLAG_COLUMN = "is_deleted"
PARTITION_COLUMN = "partition_key"
META_PREFIX = "_hoodie_"


@dataclass(frozen=True)
class TableSpec:
    """One replicated table.

    ``system`` is the name prefix of the replica, ``profile`` names the connection of the source,
    ``ordering`` is the column that decides which of two versions of a row is the later one.
    ``ordering_type`` is the type to compare it in where the replica stores it as text.
    """

    name: str
    keys: tuple[str, ...]
    ordering: str | None = None
    system: str = ""
    profile: str | None = None
    partition_col: str = PARTITION_COLUMN
    flag_col: str = FLAG_COLUMN
    meta_prefix: str = META_PREFIX
    ordering_type: str | None = None

    @property
    def target_name(self) -> str:
        return f"{self.system}_{self.name}" if self.system else self.name

    @property
    def record_key(self) -> str:
        return ",".join(self.keys)

    def path(self, template: str, **parts: str) -> str:
        """Where the replica lies: ``template`` with ``{system}``, ``{table}`` and ``parts`` filled in."""
        return template.format(system=self.system, table=self.name, **parts)

    def check(self) -> None:
        """Refuse a table that cannot be reconciled, before anything is read."""
        if not self.keys:
            raise ValueError(f"table {self.name} has no primary key columns")
        if len(set(self.keys)) != len(self.keys):
            raise ValueError(f"table {self.name} repeats a primary key column: {self.record_key}")
        if not self.ordering:
            raise ValueError(f"table {self.target_name} has no ordering column, so it is not supported")
