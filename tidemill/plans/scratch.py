"""Where checkpoints and intermediate tables go."""

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"
#: Fallback folders of local sessions by application; the setting itself can't be changed in a running session.
_LOCAL: dict[str, str] = {}


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder the cluster names.

    A machine-local folder is used only by a local session without that
    setting; on a cluster the setting is required.
    """
    base = spark.conf.get(SETTING, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {SETTING} to a folder every executor can reach")
        app = spark.sparkContext.applicationId
        base = _LOCAL.get(app) or _LOCAL.setdefault(app, tempfile.mkdtemp(prefix="tidemill-"))
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
