"""Stages from the delimited feeds to the exported tables."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiopanel.operators.crosswalk import (
    build_crosswalk,
    crosswalk_report,
    one_code_each,
    postal_codes,
    postal_regions,
    region_pairs,
)
from regiopanel.operators.doses import unexpected_levels
from regiopanel.operators.indicators import dose_column
from regiopanel.operators.ledger import NOT_IN_COUNTRY, amounts, held, ledger
from regiopanel.operators.quality import DataCheckError, profile_nulls, profile_time_series, require_empty
from regiopanel.operators.rejects import UNREADABLE, field_errors, left_out, repeated_keys
from regiopanel.operators.rollup import state_of
from regiopanel.operators.spine import day_span, outside_spine, panel_days, present
from regiopanel.operators.vintage import inherit_vintages, stamp_vintage, stamp_vintages
from regiopanel.plans.levels import (
    EXTENDED_KEYS,
    EXTENDED_NAMES,
    PLAIN_KEYS,
    PLAIN_NAMES,
    VINTAGES,
    Options,
    country_table,
    extended_layout,
    panel_places,
    placed_doses,
    plain_layout,
    region_counts,
    region_level,
    state_table,
    upper_counts,
)
from regiopanel.session import shared_folder, tune
from regiopanel.sinks.exports import export_levels
from regiopanel.sinks.tables import Buckets, Folder, current_version, replace_table, scan_table
from regiopanel.sources.feeds import Feed
from regiopanel.sources.readers import load_feeds

STAGES = ("read", "region", "state", "country", "export")

# Names of the exported tables.
OUTPUTS = {
    "region": "tab_betroffenheit_landkreis",
    "state": "tab_betroffenheit_bundesland",
    "country": "tab_betroffenheit_deutschland",
}
# Dated feeds and their keys.
PROFILED = {
    "cases": "geo",
    "doses": "place",
    "mobility_region": "nuts",
    "icu": "geo",
    "hospital": "level_id",
}
# Feeds stamped with their own latest day when they are stored.
STAMPED = {
    "doses": "day",
    "mobility_region": "day",
    "icu": "day",
    "hospital": "day",
}
# Keys of the feeds whose repeated rows would multiply or double what they are joined to.
KEYS = {
    "regions": ("geo",),
    "mobility_region": ("nuts", "day"),
    "mobility_state": ("state_name", "day"),
    "mobility_country": ("day",),
    "hospital": ("level_id", "day", "age_group"),
}
# Columns exported as percentages.
PERCENT = ("infektionsrate", "letalitaetsrate")


# Column of a stored feed with the number of a row's unreadable fields.
ERRORS = "n_errors"
# Tables that a stage reads, beside the feeds.
READS = {
    "read": (),
    "region": ("cases", "doses", "doses_by_region", "case_days", "regions", "crosswalk", "mobility_region", "icu", "hospital"),
    "state": ("upper_counts", "vintages", "read_sums", "left_out", "mobility_state", "icu", "hospital", "regions"),
    "country": ("upper_counts", "vintages", "read_sums", "left_out", "mobility_country", "icu", "hospital", "regions"),
    "export": tuple(OUTPUTS.values()),
}


class StaleError(DataCheckError):
    """A stage would read what an earlier stage made of feeds or options that have changed."""


class Pipeline:
    """Runs chosen stages; each reads the tables an earlier stage stored.

    Stored tables replace in-memory intermediates: a stage can run on its own, three
    consumers share the region counts, and a lost executor repeats one stage at most.

    Each stage leaves a manifest: a digest of the files or table versions it read and of the options.  A stage
    whose digest is unchanged, and whose tables are still there, is not run again; a stage is refused if
    one before it, that isn't run as well, would have to be.
    """

    def __init__(
        self,
        spark: SparkSession,
        feeds: Mapping[str, Feed],
        folder: str | None = None,
        options: Options = Options(),
    ):
        self.spark = tune(spark)
        self.feeds = feeds
        self.folder = (folder or f"{shared_folder(spark)}/regiopanel").rstrip("/")
        self.options = options
        self._stored: list[str] = []

    def table(self, name: str) -> DataFrame:
        return scan_table(self.spark, f"{self.folder}/{name}").drop(ERRORS)

    def store(self, name: str, df: DataFrame, buckets: Buckets | None = None) -> DataFrame:
        self._stored.append(name)
        return replace_table(df, f"{self.folder}/{name}", buckets)

    def version(self, name: str) -> str | None:
        return current_version(self.spark, f"{self.folder}/{name}")

    def run(self, stages: Iterable[str] = STAGES) -> dict[str, DataFrame]:
        """Run the stages in their order and return the level tables there are."""
        chosen = set(stages)
        unknown = chosen - set(STAGES)
        if unknown:
            raise ValueError(f"unknown stages {sorted(unknown)}")
        for stage in STAGES[: max((STAGES.index(s) + 1 for s in chosen), default=0)]:
            if self.is_current(stage):
                continue
            if stage in chosen:
                digest, self._stored = self.digest(stage), []
                getattr(self, f"_{stage}")()
                self._record(stage, digest)
            elif any(self._needs(s, stage) for s in chosen):
                raise StaleError(f"stage {stage!r} must run again: its feeds, tables or options have changed")
        built = [level for level in ("region", "state", "country") if level in chosen]
        return {level: self.table(OUTPUTS[level]) for level in built}

    @staticmethod
    def _needs(stage: str, earlier: str) -> bool:
        """Whether a stage reads, directly or not, what an earlier one stores."""
        needed = {"read": (), "region": ("read",), "state": ("read", "region"), "country": ("read", "region")}
        return earlier in needed.get(stage, STAGES)

    def digest(self, stage: str) -> str:
        """Of everything a stage depends on."""
        if stage == "read":
            read = {name: (repr(feed), Folder(self.spark, feed.path).state()) for name, feed in self.feeds.items()}
        else:
            read = {name: self.version(name) for name in READS[stage]}
        return hashlib.sha256(repr((stage, self.options, sorted(read.items()))).encode()).hexdigest()

    def _record(self, stage: str, digest: str) -> None:
        made = {name: self.version(name) for name in dict.fromkeys(self._stored)}
        row = [(digest, [f"{name} {version}" for name, version in made.items()])]
        replace_table(self.spark.createDataFrame(row, "digest string, made array<string>").coalesce(1), f"{self.folder}/manifest_{stage}")

    def is_current(self, stage: str) -> bool:
        """Whether a stage has run on what there is now, and nothing has replaced its tables since."""
        if current_version(self.spark, f"{self.folder}/manifest_{stage}") is None:
            return False
        last = self.table(f"manifest_{stage}").first()
        made = dict(entry.split(" ") for entry in last.made)
        return last.digest == self.digest(stage) and all(self.version(n) == v for n, v in made.items())

    def _read(self) -> None:
        typed = {}
        for name, df in load_feeds(self.spark, self.feeds, ERRORS).items():
            # a file is parsed once: errors are counted and vintages taken on the typed rows
            stamped = name in STAMPED
            typed[name] = self.store(f"typed_{name}" if stamped else name, df)
            if stamped:
                self.store(name, stamp_vintage(typed[name].drop(ERRORS), STAMPED[name]))
        errors = self.store("field_errors", field_errors(typed))
        keys = {name: (self.table(name), columns) for name, columns in KEYS.items()}
        repeated = self.store("repeated_keys", repeated_keys(keys))
        regions, options = self.table("regions"), self.options
        self.store("case_days", day_span(present(self.table("cases"), "geo")))
        self.store("doses_by_region", placed_doses(self.table("doses"), options))
        left_out = self.store("left_out", self._left_out())
        self.store("read_sums", self._read_sums())
        self.store("profiles", self._profiles())
        self.store("nulls", self._nulls())
        if options.strict:
            require_empty(errors, "unreadable fields")
            require_empty(left_out.filter(F.col("reason").isin(*UNREADABLE)), "rows without a usable key")
        require_empty(repeated, "repeated keys")
        require_empty(unexpected_levels(self.table("doses"), levels=options.dose_levels), "undeclared dose levels")
        city = options.city
        if options.subtotal:
            whole = self.table("cases").filter(F.col("geo") == city.key).select("geo").limit(1)
            require_empty(whole, "cases under the key of the whole city, whose districts are summed there")
        codes, postal = postal_codes(self.table("postal_nuts")), postal_regions(self.table("postal_keys"))
        crosswalk = build_crosswalk(regions, codes, postal, self.table("mobility_region"), (city.lo, city.hi))
        if options.several_codes == "weighted":
            crosswalk = one_code_each(crosswalk, region_pairs(regions), codes, postal).select("nuts", "geo")
        report = crosswalk_report(self.store("crosswalk", crosswalk), self.table("mobility_region"))
        for name, df in report.items():
            self.store(name, df)
        if options.strict:
            require_empty(self.table("codes_without_region"), "codes without a region")
        # a region with two codes would multiply its panel rows
        require_empty(self.table("regions_with_several_codes"), "regions with several codes")

    def _left_out(self) -> DataFrame:
        """Rows and counts of cases, deaths and doses that no table will hold, by reason."""
        cases, doses, options = self.table("cases"), self.table("doses"), self.options
        regions, placed = self.table("regions"), self.table("doses_by_region")
        days = panel_days(options.start, options.end, self.table("case_days"))
        places = panel_places(cases, placed, regions, options)
        return left_out(cases, doses, places, *days, levels=options.dose_levels, no_place=NOT_IN_COUNTRY)

    def _read_sums(self) -> DataFrame:
        cases = amounts(self.table("cases"), {"cases": F.col("cases"), "deaths": F.col("deaths")})
        return cases.unionByName(amounts(self.table("doses"), {"doses": F.col("doses")}))

    def _profiles(self) -> DataFrame:
        """Days and keys expected and present in each dated feed."""
        rows = [
            profile_time_series(self.table(name), key).select(F.lit(name).alias("feed"), "*")
            for name, key in PROFILED.items()
        ]
        return reduce(DataFrame.unionByName, rows)

    def _nulls(self) -> DataFrame:
        """Columns of each feed that have nulls, and how many."""
        rows = [profile_nulls(self.table(name)).select(F.lit(name).alias("feed"), "*") for name in self.feeds]
        return reduce(DataFrame.unionByName, rows)

    def _icu(self) -> DataFrame:
        return self.table("icu").withColumn("state", state_of("geo"))

    def _keep_account(self, level: str) -> None:
        """Store what the level's table holds against what was read; nothing may be unaccounted for."""
        doses = [dose_column(i) for i in self.options.dose_levels]
        in_table = held(self.table(OUTPUTS[level]), doses)
        rows = ledger(self.table("read_sums"), in_table, self.table("left_out"), level)
        require_empty(self.store(f"ledger_{level}", rows).filter("difference <> 0"), "counts unaccounted for")

    def _region(self) -> None:
        regions, options = self.table("regions"), self.options
        cases, days = self.table("cases"), self.table("case_days")
        self.store("facts_outside_spine", outside_spine(cases, options.start, options.end))
        counts = region_counts(cases, self.table("doses_by_region"), regions, options, days_of=days)
        buckets = Buckets(int(self.spark.conf.get("spark.sql.shuffle.partitions")), ("geo",), ("day",))
        counts = self.store("region_counts", counts, buckets)
        self.store("upper_counts", upper_counts(counts, self.table("doses"), regions, options, days_of=days))
        sources = {
            "rki_stand": (cases, "day"),
            "rki_impf_stand": (self.table("doses"), "day"),
            "rki_mobilitaet_stand": (self.table("mobility_region"), "day"),
            "einwohner_stand": (regions, "vintage"),
        }
        one = self.spark.range(1).select(F.lit("vintages").alias("of"))
        vintages = self.store("vintages", stamp_vintages(one, sources))
        table = region_level(
            counts,
            self.table("crosswalk"),
            self.table("mobility_region").drop("datenstand"),
            self._icu(),
            self.table("hospital"),
            regions,
            options,
        )
        self.store(OUTPUTS["region"], inherit_vintages(table, vintages, list(VINTAGES)))
        self._keep_account("region")

    def _state(self) -> None:
        table = state_table(
            self.table("upper_counts").filter("level = 'state'").drop("geo", "level"),
            self.table("mobility_state"),
            self._icu(),
            self.table("hospital"),
            self.table("regions"),
            self.options,
        )
        self.store(OUTPUTS["state"], inherit_vintages(table, self.table("vintages"), list(VINTAGES)))
        self._keep_account("state")

    def _country(self) -> None:
        table = country_table(
            self.table("upper_counts").filter("level = 'country'").drop("state", "state_name", "level"),
            self.table("mobility_country"),
            self._icu(),
            self.table("hospital"),
            self.table("regions"),
            self.options,
        )
        self.store(OUTPUTS["country"], inherit_vintages(table, self.table("vintages"), list(VINTAGES)))
        self._keep_account("country")

    def _export(self) -> None:
        self.export("plain")
        self.export("extended")

    def export(self, layout: str = "plain", levels: Iterable[str] = tuple(OUTPUTS)) -> dict[str, str]:
        """Export levels, sorted by key and day; returns the paths."""
        doses = self.options.dose_levels
        shape, named = (plain_layout, PLAIN_NAMES) if layout == "plain" else (extended_layout, EXTENDED_NAMES)
        keys = PLAIN_KEYS if layout == "plain" else EXTENDED_KEYS
        tables = {}
        for level in levels:
            key = keys[level][1]
            order = [named["day"]] if level == "country" or key is None else [key, named["day"]]
            tables[OUTPUTS[level]] = (shape(self.table(OUTPUTS[level]), level, doses), order)
        target = f"{self.folder}/{layout}"
        if layout == "plain":
            return export_levels(tables, target)
        return export_levels(tables, target, decimal_mark=".", german_days=True, percent=PERCENT)
