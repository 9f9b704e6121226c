"""From raw fields to canonical records, export records and whole harvests."""
