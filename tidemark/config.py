"""Typed configuration. Everything a sync does is decided by these values."""

from __future__ import annotations

import json
import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class TransformSpec:
    """The sections of a transformation config, in the order they are applied."""

    field_mappings: Mapping[str, str] = field(default_factory=dict)
    flatten_nested: Mapping[str, str] = field(default_factory=dict)
    type_conversions: Mapping[str, str] = field(default_factory=dict)
    default_values: Mapping[str, Any] = field(default_factory=dict)
    value_transformations: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    calculated_fields: Mapping[str, str] = field(default_factory=dict)
    iso_text: bool = False

    @classmethod
    def from_json(cls, text: str | None) -> TransformSpec:
        """Empty or unreadable text means no transformation; unknown sections are ignored."""
        if not text:
            return cls()
        try:
            sections = json.loads(text)
            known = {k: sections[k] for k in cls.__dataclass_fields__ if k in sections}
        except (ValueError, TypeError) as error:
            log.warning("transformation config ignored: %s", error)
            return cls()
        return cls(**known)

    def is_empty(self) -> bool:
        return not any(
            (
                self.field_mappings,
                self.flatten_nested,
                self.type_conversions,
                self.default_values,
                self.value_transformations,
                self.calculated_fields,
            )
        )


@dataclass(frozen=True)
class SourceSpec:
    """One source: the reader's name and that reader's own options.

    An incremental sync also takes the option ``template``: SQL with the placeholder
    ``{window}`` for the whole condition, or with ``{start_timestamp}`` and
    ``{end_timestamp}`` for its bounds. Only ``{window}`` can read the whole history.
    """

    kind: str
    options: Mapping[str, Any] = field(default_factory=dict)


@dataclass(frozen=True)
class SyncSpec:
    """How much to read. ``on_empty`` applies when the destination holds nothing."""

    incremental: bool = False
    timestamp_column: str = "updated_at"  # of the destination
    source_timestamp: str | None = None  # where the sources name it otherwise; also splits a full read over JDBC
    on_empty: str = "all_rows"  # all_rows | since_1900 | lookback
    fallback_days: int = 1
    on_error: str = "raise"  # raise | full
    auto_schema: bool = True
    measure_schema: bool = False  # nullability and document paths from a pass over the data
    mapping: str = "fixed"  # fixed | compat
    ledger: str | None = None  # a folder that keeps the mark of each run, so that the next one need not scan for it


@dataclass(frozen=True)
class SinkSpec:
    """The destination table and how it is written."""

    table: str
    path: str | None = None
    partition_field: str | None = "updated_at"
    clustering_fields: Sequence[str] = ()
    cluster: str = "files"  # files: rows are sorted in each file | table: files of a day hold ranges that are apart
    file_bytes: int = 256 * 1024 * 1024  # of a file where the table is clustered
    write: str = "append"  # append | truncate | empty
    create: str = "if_needed"  # if_needed | never
    delete_existing: bool = False
    add_columns: bool = True
    strict: bool = True


@dataclass(frozen=True)
class SyncJob:
    """``rejects_path`` receives records that fail validation, transformation or the
    destination's types, in a folder each and under the run's ``now``, so that a repeated
    run replaces its own. Without it they are kept in a new folder of the shared one (see
    ``SyncResult.rejects``), but for failed transformations: those records are written to
    the table with their original values and ``_transformation_error``.

    ``max_record_chars`` is VAL-10's limit; None lifts it. ``require_fields`` rejects a
    record that lacks a REQUIRED field.

    ``stage`` writes all records to the shared folder first, rows and rejects apart, so that each is
    evaluated once and both come from one state of the sources; without it rejects are read again,
    if there are any. It is on where ``rejects_path`` is set, unless said otherwise."""

    sources: Sequence[SourceSpec]
    sink: SinkSpec
    sync: SyncSpec = SyncSpec()
    transform: TransformSpec = TransformSpec()
    custom: Sequence[Callable] = ()
    array_literals: str = "all"  # all | repeated_only
    rejects_path: str | None = None
    max_record_chars: int | None = 104_857_600
    require_fields: bool = False
    stage: bool | None = None
