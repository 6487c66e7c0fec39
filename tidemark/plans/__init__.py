"""Composite plans: the versioned state of a feed and the batch pipeline over it."""
