"""siltstone: bronze / silver / gold tables with measured quality, on Spark."""

from siltstone.session import configure, local_session, shared_dir

__all__ = ["configure", "local_session", "shared_dir"]
