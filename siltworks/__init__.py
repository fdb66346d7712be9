"""Layered (bronze, silver, export) data tables on open PySpark."""

from .contract import (
    ColumnContract,
    ContractError,
    FlattenContract,
    TableContract,
    contract_from_dict,
    load_contract,
)

__all__ = [
    "ColumnContract",
    "ContractError",
    "FlattenContract",
    "TableContract",
    "contract_from_dict",
    "load_contract",
]
