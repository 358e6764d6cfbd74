"""Flight-itinerary and fare analytics as ``DataFrame -> DataFrame`` functions.

Nothing in this package creates a session or changes its settings; both belong
to the caller.
"""
