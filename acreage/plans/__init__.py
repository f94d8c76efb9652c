"""Jobs, input views and the registered queries."""
