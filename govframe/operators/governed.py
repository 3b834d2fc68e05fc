"""A table declared with its constraints, the DataFrame counterpart of a DDL table.

``GovernedTable`` keeps a frame together with its primary key, UNIQUE keys,
foreign keys, CHECK rules and column domains.  ``validate`` splits a batch
with all of them; ``append`` returns the next version with the accepted
rows; ``evolve`` applies column evolution to the frame *and* to every
constraint that names the column.  That is the rename-with-checks sequence
of a schema change (drop the check, rename the column, re-add the check)
done in one step.  Nothing here runs a job by itself: every method returns
lazy frames.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from govframe.operators import constraints as C
from govframe.operators.mutate import evolve as evolve_frame

# A CHECK rule is a function of the column names it uses, so it follows renames.
CheckRule = tuple[Sequence[str], Callable[..., Column]]


@dataclass(frozen=True)
class Reference:
    """A foreign key of this table: ``columns`` reference ``parent_columns`` of ``parent``."""

    columns: tuple[str, ...]
    parent: DataFrame
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class GovernedTable:
    name: str
    df: DataFrame
    primary_key: tuple[str, ...]
    unique: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    references: Mapping[str, Reference] = field(default_factory=dict)
    checks: Mapping[str, CheckRule] = field(default_factory=dict)
    domains: Mapping[str, Mapping[str, object]] = field(default_factory=dict)

    def check_columns(self) -> dict[str, Column]:
        rules = {name: fn(*[F.col(c) for c in cols]) for name, (cols, fn) in self.checks.items()}
        rules.update(C.domain_rules(self.domains))
        return rules

    def validate(self, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
        """``(accepted, rejected)`` under every declared constraint."""
        fks = [(r.parent, list(r.columns), list(r.parent_columns), name) for name, r in self.references.items()]
        return C.validated_append(self.df, batch, list(self.primary_key), foreign_keys=fks,
                                  checks=self.check_columns(), unique=dict(self.unique))

    def append(self, batch: DataFrame) -> tuple[GovernedTable, DataFrame]:
        """The next version with the accepted rows, and the rejected rows."""
        accepted, rejected = self.validate(batch)
        return replace(self, df=self.df.unionByName(accepted.select(*self.df.columns))), rejected

    def violations(self) -> dict[str, DataFrame]:
        """The current rows checked against every constraint, one frame per kind."""
        out = {"primary_key": C.pk_violations(self.df, list(self.primary_key))}
        for name, cols in self.unique.items():
            out[f"unique:{name}"] = C.unique_violations(self.df, list(cols))
        for name, r in self.references.items():
            out[f"fk:{name}"] = C.fk_violations(self.df, r.parent, list(r.columns), list(r.parent_columns))
        rules = self.check_columns()
        if rules:
            out["check"] = C.check_violations(self.df, rules)
        return out

    # ADD CONSTRAINT … only when no constraint of that name exists yet (idempotent DDL).
    def with_check(self, name: str, columns: Sequence[str], rule: Callable[..., Column]) -> GovernedTable:
        if name in self.checks:
            return self
        return replace(self, checks={**self.checks, name: (tuple(columns), rule)})

    def with_unique(self, name: str, columns: Sequence[str]) -> GovernedTable:
        if name in self.unique:
            return self
        return replace(self, unique={**self.unique, name: tuple(columns)})

    def with_reference(self, name: str, reference: Reference) -> GovernedTable:
        if name in self.references:
            return self
        return replace(self, references={**self.references, name: reference})

    def without(self, constraint: str) -> GovernedTable:
        """Drop one named CHECK, UNIQUE or foreign-key constraint."""
        return replace(self, checks={k: v for k, v in self.checks.items() if k != constraint},
                       unique={k: v for k, v in self.unique.items() if k != constraint},
                       references={k: v for k, v in self.references.items() if k != constraint})

    def evolve(self, steps: Sequence[tuple]) -> GovernedTable:
        """Column evolution that keeps the constraints attached to their columns.

        Dropping a column that a constraint still uses is refused, as a
        database refuses it: drop or change the constraint first.
        """
        used = set(self.primary_key) | {c for cols in self.unique.values() for c in cols} | \
            {c for r_ in self.references.values() for c in r_.columns} | \
            {c for cols, _ in self.checks.values() for c in cols} | set(self.domains)
        for step in steps:
            if step[0] == "drop" and step[1] in used:
                raise ValueError(f"column {step[1]!r} of {self.name} is used by a constraint")
        ren: dict[str, str] = {}
        for step in steps:
            if step[0] == "rename":
                for old, new in list(ren.items()):
                    if new == step[1]:
                        ren[old] = step[2]
                ren.setdefault(step[1], step[2])
        r = lambda c: ren.get(c, c)
        return replace(
            self,
            df=evolve_frame(self.df, steps),
            primary_key=tuple(r(c) for c in self.primary_key),
            unique={n: tuple(r(c) for c in cols) for n, cols in self.unique.items()},
            references={n: replace(ref, columns=tuple(r(c) for c in ref.columns)) for n, ref in self.references.items()},
            checks={n: (tuple(r(c) for c in cols), fn) for n, (cols, fn) in self.checks.items()},
            domains={r(c): d for c, d in self.domains.items()},
        )
