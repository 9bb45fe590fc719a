"""Contract files, stored tables and the binding to the driver's tables."""

from .contract import contract_frames, land, land_raw, read_contract_csv, require_inputs, row_counts, write_csv
from .files import signature
from .ledger import Ledger, fingerprint, inputs_key
from .tables import Frames, Tables, at_once, layer_name

__all__ = [
    "Frames",
    "Ledger",
    "Tables",
    "at_once",
    "contract_frames",
    "fingerprint",
    "inputs_key",
    "land",
    "land_raw",
    "layer_name",
    "read_contract_csv",
    "require_inputs",
    "row_counts",
    "signature",
    "write_csv",
]
