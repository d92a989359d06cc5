"""The entities that reports can name, their relations, and where their rows come from."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from .errors import SpecError


@dataclass(frozen=True)
class Relation:
    """From source.source_key to target.target_key; many when a source row can meet several target rows."""

    name: str
    source: str
    source_key: str
    target: str
    target_key: str
    many: bool = False


@dataclass(frozen=True)
class Entity:
    """id is the key column; money columns are summed as decimals; deleted marks soft-deleted rows."""

    name: str
    id: str
    money: frozenset[str] = frozenset()
    deleted: str | None = None
    captions: dict[str, str] = field(default_factory=dict)


class Catalog:
    """Names resolve exactly; an unknown name is an error, never a guess."""

    def __init__(self, read: Callable[[str], DataFrame], entities: list[Entity], relations: list[Relation]) -> None:
        self._read = read
        self.entities = {e.name: e for e in entities}
        self.relations = {(r.source, r.name): r for r in relations}
        if len(self.relations) != len(relations):
            raise SpecError("two relations of one entity share a name")

    def entity(self, name: str) -> Entity:
        name = name.removeprefix("#")
        if name not in self.entities:
            raise SpecError(f"unknown entity {name}")
        return self.entities[name]

    def relation(self, source: str, name: str) -> Relation | None:
        return self.relations.get((source, name.removeprefix("#")))

    def rows(self, name: str) -> DataFrame:
        return self._read(self.entity(name).name)


def testdata(spark: SparkSession, sf_dir: str) -> Catalog:
    """The catalog of the driver's tables. Foreign keys are relations in both directions."""
    edges = [
        ("lineitem", "order", "l_orderkey", "orders", "o_orderkey", "lines"),
        ("lineitem", "part", "l_partkey", "part", "p_partkey", "lines"),
        ("lineitem", "supplier", "l_suppkey", "supplier", "s_suppkey", "lines"),
        ("orders", "customer", "o_custkey", "customer", "c_custkey", "orders"),
        ("customer", "nation", "c_nationkey", "nation", "n_nationkey", "customers"),
        ("supplier", "nation", "s_nationkey", "nation", "n_nationkey", "suppliers"),
        ("nation", "region", "n_regionkey", "region", "r_regionkey", "nations"),
        ("documents", "label", "doc_id", "labels", "doc_id", "document"),
    ]
    relations = []
    for source, name, key, target, target_key, back in edges:
        relations += [Relation(name, source, key, target, target_key), Relation(back, target, target_key, source, key, many=source != "documents")]
    relations.append(Relation("compatriots", "customer", "c_nationkey", "customer", "c_nationkey", many=True))
    entities = [
        Entity("region", "r_regionkey"),
        Entity("nation", "n_nationkey"),
        Entity("customer", "c_custkey", frozenset({"c_acctbal"}), captions={"Name": "c_name", "Balance": "c_acctbal", "Nation": "nation"}),
        Entity("supplier", "s_suppkey", frozenset({"s_acctbal"})),
        Entity("part", "p_partkey", frozenset({"p_retailprice"})),
        Entity("orders", "o_orderkey", frozenset({"o_totalprice"}), captions={"Total": "o_totalprice", "Customer": "customer"}),
        Entity("lineitem", "l_orderkey", frozenset({"l_quantity", "l_extendedprice", "l_discount", "l_tax"}), captions={"Price": "l_extendedprice", "Discount": "l_discount", "Quantity": "l_quantity", "Order": "order"}),
        Entity("events", "event_id", frozenset({"value"})),
        Entity("documents", "doc_id"),
        Entity("labels", "doc_id"),
        Entity("pages", "page_id"),
        Entity("benchmark", "item_id"),
        Entity("conversations", "conv_id"),
    ]
    return Catalog(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"), entities, relations)
