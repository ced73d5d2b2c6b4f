from rillstone.sources.envelope import (
    EnvelopeFolder,
    KafkaTopic,
    publish,
    read_envelope_stream,
    to_envelope,
)
from rillstone.sources.compaction import compact
from rillstone.sources.expiry import expire, expired_before
from rillstone.sources.newest import newest, stored_dates
from rillstone.sources.tables import (
    arrange,
    ensure_table,
    read_table,
    rewrite_compact,
    stream_table,
    write_table,
)

__all__ = [
    "EnvelopeFolder",
    "KafkaTopic",
    "arrange",
    "compact",
    "ensure_table",
    "expire",
    "expired_before",
    "newest",
    "publish",
    "read_envelope_stream",
    "read_table",
    "rewrite_compact",
    "stored_dates",
    "stream_table",
    "to_envelope",
    "write_table",
]
