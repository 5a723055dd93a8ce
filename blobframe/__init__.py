"""Tables that hold blobs: manifests resolved against archives, partitioned tables, file export."""

import sys

from pyspark import cloudpickle

from blobframe.functions.naming import basename_col, derive_name, template_columns
from blobframe.functions.schema import (
    catalog_type,
    schema_from_json,
    schema_to_json,
    split_schema,
    with_binary_columns,
)
from blobframe.operators.fetch import NOT_FOUND, attach_content
from blobframe.operators.match import first_match
from blobframe.plans.blob_files import export_manifest, pack_manifest
from blobframe.plans.blob_table import load_blob_table
from blobframe.plans.resolve import (
    archive_members,
    fetch_members,
    index_of,
    locate_blobs,
    lookup_members,
    read_located,
    resolve_blobs,
)
from blobframe.session import (
    build_session,
    materialize,
    object_store_conf,
    release_scratch,
    scratch_dir,
)
from blobframe.sinks.files import export_blobs, pack_blobs
from blobframe.sinks.tables import (
    add_partition,
    add_partitions,
    append_files,
    append_partitioned,
    describe_table,
    distinct_keys,
    ensure_table,
    head_rows,
    managed_append,
    show_partitions,
    table_exists,
)
from blobframe.sources.archive import archive_index, list_archives, refresh_index
from blobframe.sources.listing import list_blobs
from blobframe.sources.manifest import read_manifest, scan_blobs
from blobframe.sources.packings import drop_old_packings
from blobframe.sources.store import register_store

# Executors need no copy of the package: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = [name for name in dir() if not name.startswith("_") and name not in ("sys", "cloudpickle")]
