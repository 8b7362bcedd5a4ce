"""Driver tables seen as transit data, registered queries and their SQL oracles."""
