"""A named set of lazily built tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


class Bundle(Mapping[str, DataFrame]):
    """Maps table names to DataFrames, each built when first asked for.

    Tables that many others read can be pinned before those are built:
    ``persist`` keeps blocks that a lost executor's work is recomputed for,
    ``checkpoint`` writes them to the shared checkpoint folder and cuts the
    lineage.
    """

    def __init__(
        self,
        recipes: Mapping[str, Callable[[], DataFrame]],
        shared: tuple[str, ...] = (),
        inner: Mapping[str, Callable[[], DataFrame]] | None = None,
    ) -> None:
        """``inner`` recipes are shared by tables, can be pinned, and are no tables themselves."""
        self._recipes = dict(recipes)
        self._inner = dict(inner or {})
        self._built: dict[str, DataFrame] = {}
        self._kept: list[DataFrame] = []
        self.shared = shared

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = (self._inner.get(name) or self._recipes[name])()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._recipes)

    def __len__(self) -> int:
        return len(self._recipes)

    def __contains__(self, name: object) -> bool:
        return name in self._recipes

    def pin(self, *names: str, how: str = "persist") -> "Bundle":
        """Materialise ``names`` (default: the widely read ones) for later tables.

        Persisted tables are computed here, once, so that tables written side
        by side find the blocks and don't compute them twice.
        """
        for name in names or self.shared:
            table = self[name]
            if how == "persist":
                table = table.persist(StorageLevel.MEMORY_AND_DISK)
                self._kept.append(table)
                table.count()
            elif how == "checkpoint":
                use_checkpoint_folder(table.sparkSession)
                table = table.checkpoint()
            else:
                raise ValueError("pin by 'persist' or 'checkpoint'")
            self._built[name] = table
        return self

    def release(self) -> None:
        """Drop persisted blocks; tables stay usable and are recomputed."""
        for table in self._kept:
            table.unpersist()
        self._kept.clear()

    def renamed(self, prefix: str) -> "Bundle":
        return Bundle(
            {f"{prefix}{name}": (lambda n=name: self[n]) for name in self},
            tuple(f"{prefix}{name}" for name in self.shared),
            {f"{prefix}{name}": (lambda n=name: self[n]) for name in self._inner},
        )

    def __or__(self, other: "Bundle") -> "Bundle":
        """Both bundles' tables; a name in both is an error."""
        twice = sorted(set(self) & set(other))
        if twice:
            raise ValueError(f"tables in both bundles: {', '.join(twice)}")
        recipes = {n: (lambda n=n: self[n]) for n in self}
        recipes |= {n: (lambda n=n: other[n]) for n in other}
        inner = {n: (lambda n=n, b=b: b[n]) for b in (self, other) for n in b._inner}
        return Bundle(recipes, self.shared + other.shared, inner)


def use_checkpoint_folder(spark: SparkSession) -> str:
    """Make sure checkpoints go to the folder the session's settings name."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if not folder:
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()
