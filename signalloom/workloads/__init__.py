from signalloom.workloads import carts, executive, fulfillment, quality, streams, tables  # noqa: F401
from signalloom.workloads.registry import WORKLOADS  # noqa: F401
