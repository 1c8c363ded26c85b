"""Sample inputs. The expected results below them depend on every line."""

ACTIVITY_LOG = [
    "0, AN, 1467394122, 423, 372A3SZ4J98",
    "0, AN, 1467394122, 423##############",
    "1, AK, 1467394123, 102, VIP320893JSEFE",
    "404 - broken message",
    "1, AN, 1467394123, 423, 372A3SZ4J98",
    "1, AK, 1467394120, 102, VIP320893JSEFE",
    "1, BK, 1467494150, 190, 3JISE23423J",
    "0, AK, 1467494123, 12, 320893JSEFE",
    "404 - broken message",
    "0, AN, 1467395123, 42, 372A3SZ4J98",
    "0, AK, 1467394150, 12, 320893JSEFE",
    "0, BK, 1467495150, 19, 3JISE23423J",
    "1, BK, 1467495150, 19, VIP3JISE234",
    "1, BK, 1467495150, 19, VIP34HWINF",
]

MINI_LOG = [
    "0, AN, 1467394122, 423, 372A3SZ4J98",
    "0, AN, 1467394122, 423##############",
    "404 - broken message",
    "0, AN, 1467394122, 423, 372A3SZ4J98",
]

LEGACY_LOG = [
    "1470690160, 543, 372A3SZ4J98",
    "1470690689, 543, 37289493L8J",
    "1470691286, 423, 372A3SZ4J98",
    "1470691290, 103, 34523QP323I",
]

CALL_LOG = [
    "AK 1467395123",
    "AK 1467395129",
    "AK 1467395133",
    "AN 1467395555",
    "BK 1467395000",
    "BK 1467395222",
    "BK 1467395777",
]

NAME_MAP = [
    "AN Annapolis Warehouse",
    "BK Bangkok Transfer",
    "AK Alaska Warehouse",
]
