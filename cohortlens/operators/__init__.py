"""DataFrame → DataFrame operators; all lazy unless their text says otherwise."""
