"""Study plans: concept dictionaries, the view build and the query catalogue."""
