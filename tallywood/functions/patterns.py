"""Text patterns of container logs.

Fixed values: results depend on every character of these patterns.
"""

# --- stamp, level, component -------------------------------------------------
STAMP = r"(\d{2}/\d{2}/\d{2} \d{2}:\d{2}:\d{2})"
STAMP_AT_START = r"^(\d{2}/\d{2}/\d{2} \d{2}:\d{2}:\d{2})"
LEVEL = r"(INFO|WARN|ERROR|DEBUG)"
COMPONENT = r"(INFO|WARN|ERROR|DEBUG)\s+([^:]+):"

# --- ids inside a file path --------------------------------------------------
APPLICATION_ID = r"(application_\d+_\d+)"
CLUSTER_ID = r"application_(\d+)_\d+"
APP_NUMBER = r"application_\d+_(\d+)"
CONTAINER_ID = r"(container_\d+_\d+_\d+_\d+)"
APP_MASTER_SUFFIX = "000001"

# --- known messages ----------------------------------------------------------
RESOURCE_REQUEST = (
    r"Will request (\d+) executor containers, each with (\d+) cores"
    r" and (\d+) MB memory(?: including (\d+) MB overhead)?"
)
CONTAINER_REQUEST = (
    r"Container request \(host: ([^,]+), capability: <memory:(\d+), vCores:(\d+)>\)"
)
TASK_EVENT = r"(Running|Finished) task (\d+)\.(\d+) in stage (\d+)\.(\d+) \(TID (\d+)\)"
TASK_RESULT_BYTES = r"(\d+) bytes result sent to driver"
PYTHON_TIMES = (
    r"Times: total = (-?\d+), boot = (-?\d+), init = (-?\d+), finish = (-?\d+)"
)
INPUT_SPLIT = r"Input split: (\S+):(\d+)\+(\d+)"
STORE_CAPACITY = r"MemoryStore started with capacity ([\d.]+) (B|KB|MB|GB)"
STORED_BLOCK = (
    r"Block (\S+) stored as bytes in memory"
    r" \(estimated size ([\d.]+) (B|KB|MB|GB), free ([\d.]+) (B|KB|MB|GB)\)"
)
BROADCAST_READ = r"Started reading broadcast variable (\d+)"
WORKER_HOST = r"mesos-slave-\w+"

# Bytes per unit, as the logs print sizes.
UNIT_BYTES = {"B": 1, "KB": 1024, "MB": 1024**2, "GB": 1024**3}
