from lakestrata.sinks.delivery import (
    DELIVERY_KEY,
    DELIVERY_SCHEMA,
    deliver_positional,
    delivery_ddl,
)
from lakestrata.sinks.files import write_delimited, write_layer
from lakestrata.sinks.jdbc import write_jdbc
from lakestrata.sinks.transactional import (
    DeliveryConflict,
    KeyViolation,
    create_delivery,
    deliver_load,
    drop_replaced,
    published_loads,
    read_delivery,
)
from lakestrata.sinks.versions import current_folder, drop_versions, versions

__all__ = [
    "DELIVERY_KEY",
    "DELIVERY_SCHEMA",
    "DeliveryConflict",
    "KeyViolation",
    "create_delivery",
    "current_folder",
    "deliver_load",
    "deliver_positional",
    "delivery_ddl",
    "drop_replaced",
    "drop_versions",
    "published_loads",
    "read_delivery",
    "versions",
    "write_delimited",
    "write_jdbc",
    "write_layer",
]
