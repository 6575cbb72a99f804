"""Planning, gating, auditing and validating corpora of conversations on Spark."""

from loomspan.functions.text import content_fingerprint, duration, mask, new_run_id, record_id, shape, squeezed_fingerprint, value_fingerprint
from loomspan.operators.calibration import calibrate, gate_agreement, spearman
from loomspan.operators.composition import attribute, breaches, drift, requested, shares, worst_member
from loomspan.operators.duplicates import count_duplicates, flag_duplicates
from loomspan.operators.gates import assemble, meets, structural_reason, verdict, violations
from loomspan.operators.manifest import artifact_problems, discard_counts, manifest_problems, outcome, reconcile, untraceable
from loomspan.operators.metrics import discards, histogram, progress, rates, summary
from loomspan.operators.planning import seeded_sample, slots
from loomspan.operators.privacy import Detectors, approve, blocking, covered_types, findings, matches, record_fields, reserved
from loomspan.operators.validator import all_findings, read_lines
from loomspan.schema import DEFAULT_COMPOSITION, DEFAULTS, SCHEMA_VERSION, is_supported_version, json_schema, parse_semver
from loomspan.sources.corpus import ConfigError, domain_document, load_config, publish, read_corpus, read_manifest, rubric, serialize, write_ordered

__all__ = [name for name in dir() if not name.startswith("_")]
