"""Plans that join several operators: the plant overview and the stored warehouse."""
