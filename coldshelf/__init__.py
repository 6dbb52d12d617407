"""Table archival on Spark: discover, stamp, archive, purge."""

from coldshelf.operators.archive import archive_table
from coldshelf.operators.purge import purge
from coldshelf.operators.stamp import stamp
from coldshelf.plans.fanout import archive_many
from coldshelf.plans.pipeline import run_archive
from coldshelf.sources.config import read_configs
from coldshelf.sources.jdbc import Connection
from coldshelf.sources.versions import reading
from coldshelf.streaming.requests import serve_requests

__all__ = [
    "Connection",
    "archive_many",
    "archive_table",
    "purge",
    "read_configs",
    "reading",
    "run_archive",
    "serve_requests",
    "stamp",
]
