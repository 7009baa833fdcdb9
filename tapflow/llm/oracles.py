"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from . import licenses, merkle, negatives, secrets, urlfilters

ORACLES: dict[str, str] = {
    "op1_license_scan": licenses.oracle(),
    "op3_secret_scan": secrets.oracle(),
    "op8_url_filters": urlfilters.oracle(),
    "op11_hard_negatives": negatives.oracle(),
    "op12_merkle_manifest": merkle.oracle(),
}
