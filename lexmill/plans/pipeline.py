"""Pipelines of named stages: a registry, a checked configuration, and one lineage from reader to writers."""

from __future__ import annotations

import hashlib
import importlib
import importlib.util
import json
import logging
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from importlib.metadata import entry_points
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from lexmill.functions import hashes
from lexmill.functions import text as T
from lexmill.operators import chunks, dedup, filters, project
from lexmill.sources import files

log = logging.getLogger(__name__)
Transform = Callable[[DataFrame], DataFrame]
Maker = Callable[..., Transform]


def _simple(function: Callable[..., DataFrame]) -> Maker:
    """A maker of a stage from a function of items and options."""
    return lambda **options: lambda items: function(items, **options)


def _nilsimsa(items: DataFrame) -> DataFrame:
    return items.withColumn("nilsimsa", hashes.nilsimsa_udf(T.cleanse(items["clean_visible"])))


@dataclass
class Registry:
    """Stages by name. A reader makes items of a session and input; a transform maps items; a writer takes items."""

    readers: dict[str, Callable[..., DataFrame]] = field(default_factory=dict)
    transforms: dict[str, Maker] = field(default_factory=dict)
    writers: dict[str, Callable[..., None]] = field(default_factory=dict)
    aliases: dict[str, str] = field(default_factory=dict)

    def load(self, source: str) -> None:
        """Add the ``Stages`` mapping (name to maker of a transform) of a module name or a ``.py`` file."""
        if source.endswith(".py"):
            spec = importlib.util.spec_from_file_location("external_stages", source)
            module = importlib.util.module_from_spec(spec)
            spec.loader.exec_module(module)
        else:
            module = importlib.import_module(source)
        self.transforms |= module.Stages

    def load_entry_points(self, group: str = "lexmill.stages") -> None:
        for point in entry_points(group=group):
            self.try_load(point.name, point.load)

    def try_load(self, name: str, loader: Callable[[], Maker]) -> bool:
        """Add a stage whose imports may be missing; without them it is absent, with a warning."""
        try:
            self.transforms[name] = loader()
        except ImportError as e:
            log.warning("stage %s is not available: %s", name, e)
            return False
        return True

    def transform(self, name: str, options: Mapping[str, Any]) -> Transform:
        return self.transforms[self.aliases.get(name, name)](**options)


def default_registry() -> Registry:
    from lexmill.sinks import files as sinks

    made = Registry(aliases={"dump_abs_url": "dump_ids"})
    made.readers = {"from_chunks": files.read_chunks, "from_files": files.read_files, "from_labelled_folders": lambda spark, path, **o: files.read_labelled_folders(spark, path, **o)[0], "from_social_json": lambda spark, path: files.read_social_json(spark, path)[0], "from_entity_xml": files.read_entity_xml}
    named = {
        "accept_ids": filters.accept_ids, "filter_ids": filters.filter_ids, "filter_languages": filters.filter_languages, "filter_domains": filters.filter_domains,
        "filter_domain_substrings": filters.filter_domain_substrings, "filter_exact_match": filters.filter_exact_match, "find_ids": filters.find_ids, "validate": filters.validate,
        "make_visible": project.make_visible, "visible_from_raw": project.visible_from_raw, "clean_html": project.clean_html, "force_clean_html": project.force_clean_html,
        "title": project.add_title, "set_source": project.set_source, "language": project.set_language, "remove_raw": project.remove_raw, "replace_raw": project.replace_raw,
        "guess_media_type": project.guess_media_type, "fix_text": project.fix_text, "documents_to_html": project.documents_to_html, "dump_ids": sinks.dump_ids,
        "dedup": lambda items, **o: dedup.dedup(items, dedup.DedupRule(**o)), "nilsimsa": _nilsimsa, "truncate": chunks.truncate, "cut": chunks.cut, "skip_and_limit": chunks.skip_and_limit,
    }
    made.transforms = {k: _simple(f) for k, f in named.items()}
    made.writers = {"to_chunks": sinks.write_chunks, "to_index_tables": sinks.write_index_tables, "to_side_table": sinks.write_side_table}
    return made


class ConfigError(ValueError):
    pass


@dataclass(frozen=True)
class Plan:
    """A checked configuration: a reader, transforms in order, and writers, each with its options."""

    reader: str
    transforms: tuple[str, ...]
    writers: tuple[str, ...]
    options: Mapping[str, Mapping[str, Any]]

    @classmethod
    def of(cls, config: Mapping[str, Any], registry: Registry) -> Plan:
        """Check names and shapes before any job runs. All lists of transforms are one list here, in their order."""
        if "reader" not in config:
            raise ConfigError("a pipeline needs a reader")
        steps = [s for part in ("incremental_transforms", "batch_transforms", "post_batch_incremental_transforms", "transforms") for s in config.get(part) or ()]
        writers = list(config.get("writers") or ())
        for kind, names, known in (("reader", [config["reader"]], registry.readers), ("transform", steps, registry.transforms), ("writer", writers, registry.writers)):
            for n in names:
                if registry.aliases.get(n, n) not in known:
                    raise ConfigError(f"no {kind} is named {n!r}")
        options = {n: config.get(n) or {} for n in [config["reader"], *steps, *writers]}
        for n, o in options.items():
            if not isinstance(o, Mapping):
                raise ConfigError(f"the options of {n!r} are no mapping")
        return cls(config["reader"], tuple(steps), tuple(writers), options)

    def items(self, spark: SparkSession, registry: Registry, source: str | list[str]) -> DataFrame:
        """The one lineage of all inputs; nothing runs until a writer or an action."""
        items = registry.readers[self.reader](spark, source, **self.options[self.reader])
        for name in self.transforms:
            items = registry.transform(name, self.options[name])(items)
        return items

    def run(self, spark: SparkSession, registry: Registry, source: str | list[str]) -> None:
        items = self.items(spark, registry, source)
        if len(self.writers) > 1:
            items = items.persist()
        for name in self.writers:
            registry.writers[name](items, **self.options[name])


def config_hash(config: Any) -> str:
    """The same for configurations that differ only in the order of keys."""
    return hashlib.sha1(json.dumps(config, sort_keys=True, default=str).encode()).hexdigest()


def load_config(path: str) -> dict[str, Any]:
    import yaml

    with open(path) as f:
        return yaml.safe_load(f)
