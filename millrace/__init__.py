"""millrace: retail and event analytics jobs as plain DataFrame functions."""
