"""Plans: the warehouse store, the daily batch, and the named views."""
